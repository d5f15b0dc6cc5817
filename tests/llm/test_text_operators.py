"""Language identification, token ids, decontamination, token counts: edges and
brute-force versions."""

from __future__ import annotations

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import decontam_fm, langid_zstd, token_count, token_orc
from quarry.llm.catalog import QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"
BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")

# Spaces, contractions, digits, added tokens, letters that lower-case oddly, and
# letters that combine.
PIECES = [" ", "  ", "\n", "\t", "'", "'s", "'ll", "'LL", "the", "The", "naïve", "Ünïcode", "İ", "Σ", "ς", "é",
          "12", "٣", "½", "!", "...", "<|endoftext|>", "<|startoftext|>", "中文", "🙂", " ", " ", "\x00", "﻿"]
texts = st.lists(st.sampled_from(PIECES) | st.text(max_size=6), max_size=12).map("".join).filter(
    lambda t: not any(0xD800 <= ord(c) < 0xE000 for c in t)
)
EDGES = [(0, None), (1, ""), (2, "don't we'll  go\n\n12 <|endoftext|> 'tis"), (2, "again the same id"), (3, "x" * 300_000),
         (None, "no id"), (4, " word" * 60_000)]


def documents(spark, rows=EDGES):
    """Rows with columns whose names the operators use inside."""
    return spark.createDataFrame(
        [(i, t, "src", "x", 1, 2, "r") for i, t in rows],
        "doc_id long, text string, source string, row string, part int, size int, lang string",
    )


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, max_size=4))
def test_ids_are_the_librarys(batch):
    encoder = token_orc.encoder(BYTE)
    ids, lengths = encoder.encode(batch)
    want = [e.ids + [token_orc.END_ID] for e in encoder.tok.encode_batch(batch, add_special_tokens=False)]
    assert lengths.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


COUNTER = token_count.Counter(WORD, token_count.whole_tokens(WORD))


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, max_size=4))
def test_counts_are_the_librarys(batch):
    want = [len(e.ids) for e in COUNTER.tok.encode_batch(batch, add_special_tokens=False)]
    assert COUNTER.count(batch).tolist() == want


def test_whole_tokens_encode_alone():
    tok = Tokenizer.from_file(WORD)
    whole = sorted(token_count.whole_tokens(WORD))
    assert len(whole) > 20_000
    for s in whole[::500]:
        assert len(tok.encode(s, add_special_tokens=False).ids) == 1


def test_token_counts_of_edges(spark):
    tok = Tokenizer.from_file(WORD)
    got = token_count.count_tokens(documents(spark), WORD).collect()
    want = [(i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in EDGES]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert token_count.count_tokens(documents(spark, []), WORD).count() == 0


def brute_digest(rows):
    tok, start, out = Tokenizer.from_file(BYTE), 0, []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_round_trip(spark, tmp_dir):
    rows = [(i, t) for i, t in EDGES if i != 2] + [(2, "once")]
    token_orc.write_token_orc(documents(spark, rows).repartition(3), f"{tmp_dir}/a", BYTE)
    got = [tuple(r) for r in token_orc.token_digest(spark, f"{tmp_dir}/a").collect()]
    want = brute_digest(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    assert sorted(got, key=lambda r: r[1]) == want
    # rows of one id follow each other, in an order that does not change
    twice = [tuple(r) for _ in range(2) for r in _digest_of(spark, documents(spark), tmp_dir)]
    half = len(twice) // 2
    assert sorted(map(str, twice[:half])) == sorted(map(str, twice[half:])) and half == len(EDGES)
    assert _digest_of(spark, documents(spark, []), tmp_dir) == []


def _digest_of(spark, docs, tmp_dir):
    path = f"{tmp_dir}/{os.urandom(4).hex()}"
    token_orc.write_token_orc(docs, path, BYTE)
    return token_orc.token_digest(spark, path).collect()


def test_token_files_have_indexes_and_prune(spark, tmp_dir):
    import pyarrow.orc as orc

    docs = spark.range(2_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    token_orc.write_token_orc(docs, f"{tmp_dir}/t", BYTE, row_group=1_000)
    files = [f"{tmp_dir}/t/{f}" for f in os.listdir(f"{tmp_dir}/t") if f.endswith(".orc")]
    starts = sorted(orc.ORCFile(f).read(columns=["doc_id"])["doc_id"].to_pylist() for f in files)
    assert sum(starts, []) == list(range(2_000))
    one = token_orc.read_token_orc(spark, f"{tmp_dir}/t").where("doc_id = 1234")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,1234)]" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1


def test_op3_on_documents(spark):
    import pyarrow.parquet as pq

    t = pq.read_table(f"{SF}/documents.parquet").to_pandas().sort_values("doc_id")
    got = sorted(tuple(r) for r in QUERIES["op3_token_orc"](spark, SF).collect())
    assert got == brute_digest(zip(t.doc_id.tolist(), t.text.tolist()))


def test_op10_on_documents(spark):
    import pyarrow.parquet as pq

    t = pq.read_table(f"{SF}/documents.parquet").to_pandas()
    tok = Tokenizer.from_file(WORD)
    want = {(i, len(x.encode()), len(tok.encode(x, add_special_tokens=False).ids)) for i, x in zip(t.doc_id, t.text)}
    got = QUERIES["op10_token_count"](spark, SF).collect()
    assert {tuple(r)[:3] for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)


# ---------------------------------------------------------------------------
# Language identification


def test_language_accuracy_on_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op2_langid_zstd"](spark, sf).join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).collect()
    assert len(got) == 1000
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.rejected for r in got) < 0.02 * len(got)


def test_language_edges(spark):
    train = spark.createDataFrame(
        [(k, "the cat and the dog with the house", "en") for k in range(20)]
        + [(k, "der hund und die katze mit dem haus", "de") for k in range(20, 40)]
        + [(40, None, "en"), (41, "text without a language", None)],
        "doc_id long, text string, lang string",
    )
    model = langid_zstd.train(train)
    assert sorted(model) == ["de", "en"]
    docs = spark.createDataFrame(
        [(0, None), (1, ""), (2, "123 456 !!"), (3, "the dog and the cat"), (3, "der hund und die katze"),
         (None, "the house with the cat " * 20_000)],
        "doc_id long, text string",
    ).withColumn("row", F.lit(1)).withColumn("score", F.lit("x"))
    got = [(r.doc_id, r.lang_pred, r.rejected) for r in langid_zstd.identify(docs, model).collect()]
    assert got == [(0, "und", True), (1, "und", True), (2, "und", True), (3, "en", False), (3, "de", False), (None, "en", False)]
    one = {"en": model["en"]}
    assert [r.score for r in langid_zstd.identify(docs, one).where("doc_id = 3").collect()] == [1.0, 1.0]
    assert langid_zstd.train(train.limit(0)) == {}
    assert {r.lang_pred for r in langid_zstd.identify(docs, {}).collect()} == {"und"}
    assert langid_zstd.identify(docs.limit(0), model).count() == 0


def test_language_equals_plain_compression(spark):
    """Every text of the table, compressed whole with each dictionary in plain Python."""
    import zstandard

    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    model = langid_zstd.train(spark.read.parquet(f"{SF}/documents.parquet").where(~langid_zstd.held_out()))
    params = zstandard.ZstdCompressionParameters(**langid_zstd._SEARCH, **langid_zstd._FRAME)
    want = set()
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            want.add((r.doc_id, "und", 0.0))
            continue
        rest, size = f" {r.text.lower()} ".encode(), dict.fromkeys(sorted(model), 0)
        while rest:
            cut = len(rest)
            if cut > 32_768:
                cut = max((k + 1 for k in range(16_384, 32_768) if rest[k] == 32), default=32_768)
            for lang in size:
                known = zstandard.ZstdCompressionDict(model[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                known.precompute_compress(compression_params=params)
                coder = zstandard.ZstdCompressor(compression_params=params, dict_data=known)
                size[lang] += len(coder.compress(rest[:cut])) - 6
            rest = rest[cut:]
        best = min(size, key=size.get)
        second = min(n for lang, n in size.items() if lang != best)
        want.add((r.doc_id, best, (second - size[best]) / second))
    got = QUERIES["op2_langid_zstd"](spark, SF).collect()
    assert {(r.doc_id, r.lang_pred, r.score) for r in got} == want and len(got) == len(rows)
    assert all(r.rejected == (r.lang_pred == "und" or r.score < langid_zstd.MIN_MARGIN) for r in got)


def test_language_learns_within_its_bounds(spark):
    docs = spark.createDataFrame(
        [(k, f"prefix{k} " + f"{w} " * 5_000, lang) for k in range(400) for w, lang in ((f"wort{k}", "de"), (f"word{k}", "en"))],
        "doc_id long, text string, lang string",
    )
    model = langid_zstd.train(docs, docs_per_lang=100, excerpt_chars=200, dict_bytes=10_000)
    assert {lang: len(d) for lang, d in model.items()} == {"de": 10_000, "en": 10_000}
    # Excerpts start anywhere in a text, not at its beginning.
    assert all(d.count(b"prefix") < 25 for d in model.values())
    assert langid_zstd.train(docs, docs_per_lang=100, excerpt_chars=200, dict_bytes=10_000) == model


def long_texts():
    """All texts of each language one after the other."""
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text", "lang"]).to_pandas()
    return {lang: " ".join(g) for lang, g in t.groupby("lang")["text"]}


def test_pieces_are_the_whole_text():
    for data in (b"", b"a", b"ab " * 50_000, b"x" * 100_000, b"x" * 40_000 + b" y" * 40_000):
        cut = langid_zstd.pieces(data)
        assert b"".join(cut) == data and all(len(c) <= langid_zstd.PIECE_BYTES for c in cut)


def test_long_text_is_judged_by_all_of_it(spark):
    own = long_texts()
    predict = langid_zstd.Classifier(langid_zstd.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))).predict
    for first, n, then, m in (("de", 100, "en", 1_500), ("en", 100, "de", 1_500), ("fr", 60, "en", 700), ("en", 50, "de", 300)):
        lang, score = predict(own[first][: n * 1_000] + " " + own[then][: m * 1_000])
        assert lang == then and score >= langid_zstd.MIN_MARGIN


def test_language_stage_keeps_long_texts_of_one_language(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    long = [(-k, text[:2_000_000], lang) for k, (lang, text) in enumerate(long_texts().items(), 1)]
    assert len(long) == 4 and all(len(t) == 2_000_000 for _, t, _ in long)
    added = spark.createDataFrame(long, "doc_id long, text string, lang string")
    given = docs.unionByName(added.withColumns({"source": F.lit("x"), "n_chars": F.length("text")}))
    kept = cp.language_stage(spark, given, "").where("doc_id < 0")
    assert sorted(r.doc_id for r in kept.collect()) == [-4, -3, -2, -1]


# ---------------------------------------------------------------------------
# Decontamination

WORDS = st.lists(st.sampled_from(["a", "B", "c", "d9", "é", "zz"]), max_size=30).map(" - ".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=6), st.lists(WORDS, max_size=4), st.integers(1, 6))
def test_fm_index_finds_what_brute_force_finds(docs, items, window):
    phrases = decontam_fm.Phrases([(str(k), t) for k, t in enumerate(items)], window)
    raw = [d.encode() for d in docs]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    n_words, spans, found = decontam_fm.find_hits(data, offsets, phrases)
    want = brute.decontaminated(enumerate(docs), enumerate(items), window)
    got = [
        (k, int(n_words[k]), sum(b - a for a, b in spans[k]), len(found[k]), found[k]) for k in range(len(docs))
    ]
    assert [g[:4] for g in got] == [w[:4] for w in want]


def _decontaminated(spark, docs, items, **kw):
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam_fm.decontaminate(docs, bench, **kw).collect()
    return sorted(
        (str(r.doc_id), r.n_words, sum(s.stop - s.start for s in r.spans), len(r["items"])) for r in rows
    )


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontamination_edges(spark, block_bytes):
    docs = [(0, None), (1, ""), (2, "say one TWO three! four"), (2, "say one TWO three! four"), (None, "one two three"),
            (5, "filler " * 50_000 + "one two three four five"), (6, "clean words only")]
    items = [(7, "one two three four five"), (8, "three four"), (8, "three four"), (9, None), (10, "..."), (None, "two three")]
    got = _decontaminated(spark, documents(spark, docs), items, window=3, block_bytes=block_bytes)
    want = sorted(
        (str(d), n, h, i) for d, n, h, i, _ in brute.decontaminated(docs, [(k if k is not None else "null", t) for k, t in items], 3)
    )
    assert got == want
    assert _decontaminated(spark, documents(spark, []), items) == []
    assert all(r[2] == 0 for r in _decontaminated(spark, documents(spark, docs), []))


def test_op4_on_documents(spark):
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.01"
    d, b = (pq.read_table(f"{sf}/{t}.parquet").to_pandas() for t in ("documents", "benchmark"))
    want = {x[0]: x for x in brute.decontaminated(zip(d.doc_id, d.text), zip(b.item_id, b.text))}
    got = QUERIES["op4_decontam_fm"](spark, sf).collect()
    assert len(got) == len(want) and sum(r.contaminated for r in got) > 10
    for r in got:
        assert (r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256) == want[r.doc_id]
        assert r.contaminated == (r.n_hit > 0)
