"""Rows are carried through every stage whole, whatever their other columns are called;
near copies do not multiply in the buckets."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import minhash_bbit
from quarry.llm.common import read_table

SF = "/root/testdata/sf0.001"
# Output names of the operators and names the stages use inside.
CLASHES = (
    "score", "rejected", "lang_pred", "held_out", "spans", "items", "n_words", "digest", "size", "source_size", "target",
    "taken", "row", "n_shingles", "component_id", "kept", "text_md5", "d1", "d2", "rep", "h", "uid", "start", "n_tokens",
    "ids", "ids_crc32", "_md5", "_id", "_order", "_kept_0", "copy", "times",
)


@pytest.mark.parametrize("name,step", corpus_pipeline.STAGES)
def test_stages_carry_any_columns(spark, name, step):
    docs = read_table(spark, SF, "documents").limit(120)
    docs = docs.unionByName(docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    odd = docs.select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASHES)), F.create_map(F.lit("k"), "doc_id").alias("m"))
    got, want = step(spark, odd, SF), step(spark, docs, SF)
    if name == "token_orc":
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        return
    assert got.columns == odd.columns
    rows = got.collect()
    assert all([r[c] for c in CLASHES] == list(range(len(CLASHES))) and r["m"] == {"k": r.doc_id} for r in rows)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")
    assert sorted(map(key, rows)) == sorted(map(key, want.collect()))


def near_copies(rng, n, words, kept):
    """Texts that each keep a share of one base text: alike, but under the threshold."""
    base = [f"w{k}" for k in rng.integers(0, 10**6, words)]
    for k in range(n):
        mine = rng.random(words) < kept
        yield k, " ".join(w if own else f"x{k}_{j}" for j, (w, own) in enumerate(zip(base, mine)))


def test_members_are_not_copied_by_the_size_of_their_group(spark, monkeypatch):
    """Cell rows for each open member stay what they are from 500 to 4,000 near copies."""
    seen = {}
    real = minhash_bbit._open_cells

    def counted(fine, cell):
        cells = real(fine, cell)
        seen["per_member"] = cells.count() / max(1, fine.select("rep").distinct().count())
        return cells

    monkeypatch.setattr(minhash_bbit, "_open_cells", counted)
    found = {}
    for n in (500, 1_000, 4_000):
        docs = spark.createDataFrame(list(near_copies(np.random.default_rng(n), n, 120, 0.93)), "doc_id long, text string")
        minhash_bbit.near_duplicates(docs).count()
        found[n] = seen["per_member"]
    assert all(v <= minhash_bbit.FINE_BANDS for v in found.values()), found
    assert found[4_000] <= 2.5 * max(1.0, found[1_000]), found


def test_tidy_tasks_keep_their_rows(spark):
    import pyarrow as pa

    from quarry.llm.common import tidy

    @tidy
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id")], ["id"])

    assert spark.range(10_000).mapInArrow(run, "id long").distinct().count() == 10_000
    assert spark.range(0).mapInArrow(run, "id long").count() == 0
    assert list(run(iter([]))) == []
