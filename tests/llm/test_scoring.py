"""Decontamination, language identification, toxicity, preference pairs, packing."""

from __future__ import annotations

import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daybook.llm import decontaminate, language_id, packing, preference, toxicity
from daybook.llm.rows import held_out
from daybook.llm.suffix_automaton import WindowAutomaton
from tests.llm import brute, cases
from tests.llm.test_dedup import ordered, tuples

JUDGED = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("block,passes", [(200_000, 40), (30, 40), (30, 1)])
def test_contamination(spark, monkeypatch, block, passes):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    monkeypatch.setattr(decontaminate, "PASS_BLOCKS", passes)
    rng = random.Random(5)
    text = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(["a", "b", "The"], rng.choice([5, 12, 13, 14, 25]))) for i in range(20)]
    items += [(90, cases.PASSAGE), (91, None), (92, ""), (None, "one two"), (93, "One, two"), (94, "ÉTÉ 12")]
    docs = cases.documents() + [(600 + i, text(["a", "B", "the", "x"], rng.choice([0, 4, 60, 200]))) for i in range(40)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    out = decontaminate.find_contamination(cases.frame(spark, docs), benchmark)
    assert tuples(out, *JUDGED) == ordered(brute.contamination(docs, items))
    assert out.columns[:9] == cases.frame(spark).columns


def test_nothing_to_find(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    out = decontaminate.find_contamination(cases.frame(spark), none)
    assert out.where("n_hit > 0 OR contaminated").count() == 0 and out.count() == len(cases.documents())
    assert decontaminate.find_contamination(cases.empty(spark), none).count() == 0
    clash = cases.frame(spark).withColumnRenamed("score", "n_hit")  # a result replaces a column of its name
    assert decontaminate.find_contamination(clash, none).columns.count("n_hit") == 1


def most_held(work):
    """Bytes that Python and numpy hold at once beyond what they held before."""
    work()  # fills tables that are kept
    tracemalloc.start()
    work()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_words_of_one_slice_are_held_at_a_time():
    texts = pa.array([cases.PASSAGE + " x y z" * 10_000] * 100)
    batch = lambda n: pa.RecordBatch.from_arrays([texts.slice(0, n)], names=["text"])
    detector = decontaminate.Detector([("7", decontaminate.word_hashes([cases.PASSAGE])[0])])
    judge = lambda n: decontaminate._judge(batch(n), "text", lambda: [detector], False)
    assert [a.to_pylist() for a in judge(100)] == [a.to_pylist() * 100 for a in judge(1)]
    assert most_held(lambda: judge(100)) < 2 * most_held(lambda: judge(20))


def test_counts_of_few_texts_are_held_at_a_time():
    texts = [f"word {i} of many" for i in range(4_000)]
    body = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    whole = language_id.features(body, offsets)
    for i in (0, 63, 64, 3_999):
        assert (whole[i] == language_id.features(body, offsets[i: i + 2])[0]).all()
    assert most_held(lambda: language_id.features(body, offsets)) < 1.5 * whole.nbytes


def test_matching_lengths_of_the_automaton():
    rng = random.Random(9)
    for _ in range(30):
        items = [(i, [rng.randrange(3) for _ in range(rng.randint(1, 12))]) for i in range(5)]
        a = WindowAutomaton(items, 4).automaton
        state = matched = 0
        stream = [rng.randrange(4) for _ in range(60)]
        parts = {tuple(s[i:j]) for _, s in items for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        for n, symbol in enumerate(stream, 1):
            state, matched = a.step(state, matched, symbol)
            assert matched == max((k for k in range(n + 1) if k == 0 or tuple(stream[n - k: n]) in parts))


def test_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.train(docs, teaches=~held_out(F.col("doc_id")))
    assert model.languages == ["de", "en", "es", "fr"] and model.words.shape == (4, 7)
    again = language_id.train(docs.repartition(7), teaches=~held_out(F.col("doc_id")))
    assert np.array_equal(model.weights, again.weights)  # whatever order the rows come in
    unseen = language_id.predict(docs, model).where(held_out(F.col("doc_id")))
    assert unseen.where("lang = lang_pred").count() >= 0.95 * unseen.count()
    odd = language_id.predict(cases.frame(spark), model)
    assert odd.columns[:8] == ["doc_id", "text", "lang", "source", "n_chars", "key", "who", "sha"]  # score is replaced
    und = {r.doc_id for r in odd.where("lang_pred = 'und'").collect()}
    assert und == {100, 101, 102, 112, None} and odd.where("lang_pred = 'und' AND score <> 0").count() == 0
    assert odd.where("score < 0 OR score > 1").count() == 0 and odd.count() == len(cases.documents())


def test_language_without_labels(spark):
    assert language_id.train(cases.empty(spark)) is None
    none = language_id.predict(cases.frame(spark), None)
    assert none.where("lang_pred <> 'und' OR score <> 0").count() == 0
    one = language_id.train(cases.frame(spark))
    assert one.languages == ["en"]
    assert {r.lang_pred for r in language_id.predict(cases.frame(spark), one).collect()} == {"en", "und"}


def test_codewords_are_apart():
    for n in (2, 3, 6, 7, 30):
        words = language_id.codewords(n)
        distance = [(words[i] != words[j]).sum() for i in range(n) for j in range(i)]
        assert min(distance) >= (1 if n < 4 else 4) and (np.abs(words.sum(axis=0)) < n).all()


def test_toxicity(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels, teaches=~held_out(F.col("doc_id")))
    judged = toxicity.score(docs, model).join(labels, "doc_id").where(held_out(F.col("doc_id")))
    caught, toxic = judged.where("predicted = 1 AND toxic = 1").count(), judged.where("toxic = 1").count()
    false, clean = judged.where("predicted = 1 AND toxic = 0").count(), judged.where("toxic = 0").count()
    assert caught >= 0.6 * toxic and false <= 0.15 * clean
    odd = toxicity.score(cases.frame(spark), model)
    assert odd.count() == len(cases.documents()) and odd.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert toxicity.train(docs, labels.where("toxic = 0")) is None
    assert toxicity.score(docs, None).where("score <> 0 OR predicted <> 0").count() == 0
    assert toxicity.score(cases.empty(spark), model).count() == 0


def test_the_risk_stays_non_negative():
    rng = np.random.default_rng(0)
    positive = (rng.random((200, 6)) < [0.9, 0.8, 0.1, 0.1, 0.5, 0.5]).astype(np.float32)
    clean = (rng.random((900, 6)) < [0.05, 0.05, 0.1, 0.1, 0.5, 0.5]).astype(np.float32)
    unlabelled = np.vstack([clean, (rng.random((100, 6)) < [0.9, 0.8, 0.1, 0.1, 0.5, 0.5]).astype(np.float32)])
    weights, bias = toxicity.fit(positive, unlabelled, 0.1)
    p = lambda x: 1 / (1 + np.exp(-(x @ weights + bias)))
    assert p(positive).mean() > 0.6 > 0.15 > p(clean).mean()


def test_preference(spark):
    turns = [(0, 0, "system", "be kind"), (0, 1, "user", "hi"), (0, 2, "assistant", "hello"), (0, 2, "assistant", "hello"),
             (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "no"), (1, 3, None, None),
             (2, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "user", "alone"), (None, 0, "user", "x"), (7, None, "user", "y")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("pair_id", F.lit(1))
    pairs = preference.neighbouring_pairs(df)
    out = {r.pair_id: r for r in preference.preference_examples(df, pairs).collect()}
    assert set(out) == {0, 1}
    one = out[0]
    assert one.n_shared == 2 and one.prompt == "<|system|>\nbe kind<|end|>\n<|user|>\nhi<|end|>\n"
    assert one.chosen == "<|assistant|>\nhello<|end|>\n" and one.rejected == "<|assistant|>\nno<|end|>\n<|unknown|>\n<|end|>\n"
    assert [one.chosen[s.start: s.end] for s in one.chosen_loss] == ["hello<|end|>\n"]
    assert [one.rejected[s.start: s.end] for s in one.rejected_loss] == ["no<|end|>\n"]
    assert (out[1].n_shared, out[1].chosen, out[1].rejected) == (1, "", "")
    nothing = df.limit(0)
    assert preference.preference_examples(nothing, preference.neighbouring_pairs(nothing)).count() == 0


PATH, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{end}") for end in ("json", "tiktoken"))


def check_packing(pieces, docs, limits=packing.LIMITS):
    """An exact round trip: every id of every row in one piece, every sequence gapless and within its limits."""
    full = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for d, t in docs:
        want[d].append(np.array([*full.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4"))
    sequences, found = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        found[p.doc_id].append((p.start, p.doc_tokens, p.ids_crc32, p.length))
    padding = 0
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        total = sum(p.length for p in own)
        assert total <= limits[0] and len(own) <= limits[1] and total - len(own) <= limits[2]
        padding += 0 if total & (total - 1) == 0 else limits[0] - total
    for d, texts in want.items():
        assert sum(x[3] for x in found[d]) == sum(map(len, texts))
        for ids in texts:
            own = sorted(x for x in found[d] if x[1] == len(ids))
            if sum(len(t) == len(ids) for t in texts) > 1:
                continue  # rows that agree in id and length can't be told apart here
            at = 0
            for start, _, crc, length in own:
                assert start == at and crc == zlib.crc32(ids[at: at + length].tobytes())
                at += length
            assert at == len(ids)
    assert set(found) == set(want)
    return padding


def test_packing(spark):
    docs = cases.documents()
    out = packing.pack(cases.frame(spark, docs), PATH, RANKS).withColumn("ids_crc32", F.crc32("ids"))
    assert check_packing(out.collect(), docs) == 0
    slow = packing.pack(cases.frame(spark, docs).coalesce(1), PATH, None).withColumn("ids_crc32", F.crc32("ids"))
    assert check_packing(slow.collect(), docs) == 0
    tight = (2048, 3, 1500)
    few = packing.pack(cases.frame(spark, docs).coalesce(1), PATH, RANKS, limits=tight).withColumn("ids_crc32", F.crc32("ids"))
    check_packing(few.collect(), docs, tight)
    assert packing.pack(cases.empty(spark), PATH, RANKS).count() == 0


def test_fast_ids_are_the_tokenizers_ids():
    both = packing.Tokenizer(PATH, RANKS)
    texts = [t or "" for _, t in cases.documents()] + ["a  b", "tail ", " \n lead", "it's  'LL", "日本語 ١٢", "x y z", "<|endoftext|>"]
    for t in texts:
        assert both.ids(t).tolist() == both.full.encode(t, add_special_tokens=False).ids


def test_sequences_that_the_segment_limit_closes_need_no_padding():
    packer = packing.Packer()
    pieces = [packing.Piece(i, 0, np.arange(5, dtype=np.uint32), 5) for i in range(3_000)]
    made = [s for p in pieces for s in packer.add(p)]
    assert made
    made += packer.finish()
    assert all(n & (n - 1) == 0 for n in (sum(len(p.ids) for p in s) for s in made))
    assert sum(len(p.ids) for s in made for p in s) == 15_000 and max(map(len, made)) <= packing.LIMITS[1]
