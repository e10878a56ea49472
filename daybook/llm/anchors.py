"""Anchors: content-chosen places such that equal strings of ``length`` bytes contain equal ones at equal offsets.

The anchor of a window of ``length`` bytes is the first of its GRAM-byte strings with the smallest hash. Which
windows of a text repeat can then be found by comparing only places with the same anchor.
"""

from __future__ import annotations

import numpy as np

from daybook.llm.tokens import _OF_BYTE, mix, prefix_hashes, span_hashes

GRAM = 48


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of values[i: i + width] for every whole window: running minima within blocks, from both ends."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1: n])


def anchors(body: np.ndarray, offsets: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of the texts that ``offsets`` cuts out of ``body``: the anchors with the windows that are theirs.

    Returns text number, place in the text, hash of the anchor, hash of its surroundings (all bytes of its windows),
    and how far before the anchor its first and its last window start.
    """
    base = offsets[0]
    part = body[base: offsets[-1]]
    at = offsets - base
    n = len(part)
    none, no_hash = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    if n < length:
        return none, none, no_hash, no_hash, none, none
    h = prefix_hashes(_OF_BYTE[part])
    start = np.arange(n - gram + 1)
    grams = span_hashes(h, start, start + gram)
    width = length - gram + 1
    least = _least(grams, width)  # by window start
    whole = np.arange(len(least)) + length <= np.repeat(at[1:], np.diff(at))[: len(least)]
    # runs of windows with one least value, in whole windows
    change = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (whole[1:] != whole[:-1])]))
    run_end = np.append(change[1:], len(least)) - 1
    real = whole[change]
    first, last = change[real], run_end[real]
    if not len(first):
        return none, none, no_hash, no_hash, none, none
    # the places of each run's least value: all equal grams, found by value and place
    value = least[first]
    known, value_no = np.unique(value, return_inverse=True)
    at_known = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    place = np.flatnonzero(known[at_known] == grams)
    place_no = at_known[place]
    order = np.argsort(place_no, kind="stable")
    place, place_no = place[order], place_no[order]
    run_order = np.lexsort((first, value_no))
    first, last, value_no = first[run_order], last[run_order], value_no[run_order]
    big = np.int64(n + 1)
    run = np.searchsorted(value_no * big + first, place_no * big + place, side="right") - 1
    fits = (run >= 0) & (value_no[np.maximum(run, 0)] == place_no)
    before = np.concatenate([[-1], place[:-1]])
    before[np.concatenate([[True], place_no[1:] != place_no[:-1]])] = -1
    low = np.maximum(first[run], before + 1)
    high = np.minimum(last[run], place)
    fits &= (low <= high) & (place - low < width)
    place, low, high = place[fits], low[fits], high[fits]
    text = np.searchsorted(at, place, side="right") - 1
    context = mix(span_hashes(h, low, high + length) + mix(((place - low) << 20 | (place - high)).astype(np.uint64)))
    return text, place - at[text], grams[place], context, place - low, place - high
