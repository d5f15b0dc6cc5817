"""Language identification by compression.

Every language has one zstandard raw-content dictionary, made from a bounded sample of
its labelled texts. All of a text, in lower case, is compressed with the dictionary of
each language; the language with the smallest total wins, and a text whose margin over
the second language is narrow is rejected. Texts of all lengths are judged alike.

A text is compressed in pieces of at most ``PIECE_BYTES``, each a frame of its own
and so beside the whole dictionary. In one frame a long text would serve as its own
dictionary: its start would decide, and the margin would fall as one over its length.

The sample: about ``docs_per_lang`` documents of each language, picked by a
seeded hash of their id at a rate set from the language's count, and of each at most
``excerpt_chars`` characters at a place that the hash sets too. So the driver holds
languages x docs_per_lang x excerpt_chars at most, and the dictionaries (languages x
``dict_bytes``) go to every worker. Prediction reads nothing but the text.

Defined results: a text that is null or has no letter is ``und`` with score 0; with
one learned language all other texts get it with score 1; with none all are ``und``;
equal sizes go to the first language by name. Repeated rows are judged each; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import tidy

UNKNOWN = "und"
DOCS_PER_LANG = 300
EXCERPT_CHARS = 1_000
DICT_BYTES = 256 << 10
PIECE_BYTES = 32 << 10
MIN_MARGIN = 0.004
SEED = 11

# Tables and window that fit the dictionary beside a piece; frames with the least header.
_SEARCH = {
    "window_log": 19, "chain_log": 18, "hash_log": 18, "min_match": 4,
    "strategy": zstandard.STRATEGY_BTLAZY2, "search_log": 2, "target_length": 32,
}
_FRAME = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
_FRAME_BYTES = 6

Model = dict[str, bytes]


def held_out(id_col: str = "doc_id") -> Column:
    """True for the third of the documents that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    docs_per_lang: int = DOCS_PER_LANG, excerpt_chars: int = EXCERPT_CHARS,
    dict_bytes: int = DICT_BYTES, seed: int = SEED,
) -> Model:
    """The raw-content dictionary of each language of the labelled rows of ``docs``."""
    labelled = docs.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        F.xxhash64(F.lit(seed), F.col(id_col)).alias("h"),
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # One row for each language. A literal map keeps the texts from being shuffled
    # to their language for a join.
    counts = [(r.lang, r["count"]) for r in labelled.groupBy("lang").count().collect()]
    if not counts:
        return {}
    rate = F.create_map(*(F.lit(x) for lang, n in counts for x in (lang, docs_per_lang / n)))
    share = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))
    picked = labelled.where(share < rate[F.col("lang")])
    places = F.greatest(F.length("text") - excerpt_chars, F.lit(0)) + 1
    excerpt = F.substring(F.col("text"), (F.pmod("h", places) + 1).cast("int"), F.lit(excerpt_chars))
    rows = picked.select("lang", "h", excerpt.alias("text")).collect()
    texts: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.h, r.text)):
        texts.setdefault(r.lang, []).append(r.text.lower())
    whole = {lang: "\n".join(dict.fromkeys(own)) for lang, own in texts.items()}
    return {lang: t.encode("utf-8", "surrogatepass")[:dict_bytes] for lang, t in whole.items()}


def pieces(data: bytes) -> list[bytes]:
    """``data`` in pieces of at most ``PIECE_BYTES``, cut after a space if there is one
    in the second half of a piece."""
    out, start = [], 0
    while len(data) - start > PIECE_BYTES:
        end = start + PIECE_BYTES
        stop = data.rfind(b" ", end - PIECE_BYTES // 2, end) + 1 or end
        out.append(data[start:stop])
        start = stop
    return [*out, data[start:]]


class Classifier:
    def __init__(self, model: Model):
        # zstandard takes content of eight bytes or more.
        self.coders = {lang: self._coder(data) for lang, data in sorted(model.items()) if len(data) >= 8}

    @staticmethod
    def _coder(content: bytes) -> zstandard.ZstdCompressor:
        params = zstandard.ZstdCompressionParameters(**_SEARCH, **_FRAME)
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(compression_params=params)
        return zstandard.ZstdCompressor(compression_params=params, dict_data=data)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and margin: how much smaller the best size is than the second."""
        if not text or not self.coders or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        data = f" {text.lower()} ".encode("utf-8", "surrogatepass")
        parts = pieces(data)
        sizes = sorted(
            (sum(len(coder.compress(part)) - _FRAME_BYTES for part in parts), lang)
            for lang, coder in self.coders.items()
        )
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        best, second = sizes[0][0], sizes[1][0]
        return sizes[0][1], min(1.0, max(0.0, (second - best) / max(second, 1.0)))


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
    min_margin: float = MIN_MARGIN, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: id, the columns ``keep``, ``lang_pred``, ``score`` (the margin) and
    ``rejected`` (no language, or a margin under ``min_margin``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = Classifier(shared.value).predict
        for batch in batches:
            found = [predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[0] == UNKNOWN or f[1] < min_margin for f in found], pa.bool_()),
                ],
                ["row", "lang_pred", "score", "rejected"],
            )

    given = docs.select(F.struct(id_col, *keep).alias("row"), F.col(text_col).alias("text"))
    row = given.schema["row"].dataType.simpleString()
    judged = given.mapInArrow(run, f"row {row}, lang_pred string, score double, rejected boolean")
    return judged.select("row.*", "lang_pred", "score", "rejected")
