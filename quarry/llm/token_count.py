"""Token counts by the whole-token shortcut.

Offline, once: every vocabulary string that ends a word is put to the tokenizer
alone; those that come back as one token are proven whole tokens. Online, a
pre-token that is a whole token counts one without any merging, and only the
rest is merged (by the library's model, once per distinct pre-token and
worker). The result is the library's own count for every text.

Defined results: a null text counts as empty (0 tokens, 0 bytes); a text that
holds a string of an added token goes through the library whole; a text with
letters that the fast lower-casing does not know is normalized by the library
first. Repeated rows are counted each; other columns of the input are ignored.
The work is one narrow pass: no shuffle, nothing collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import pretokens as pt
from quarry.llm.common import row_chunks

WINDOW_BYTES = 8 << 20
WORD_END = "</w>"


@lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings (in the vocabulary's letters, without the word end)
    that the tokenizer, given the string alone, returns as that one token."""
    tok = load(path)
    letter_bytes = {c: b for b, c in pt._ALPHABET.items()}
    strings, ids = [], []
    for piece, at in tok.get_vocab(with_added_tokens=False).items():
        if piece.endswith(WORD_END) and all(c in letter_bytes for c in piece[: -len(WORD_END)]):
            raw = bytes(letter_bytes[c] for c in piece[: -len(WORD_END)])
            try:
                strings.append(raw.decode("utf-8"))
                ids.append(at)
            except UnicodeDecodeError:
                continue  # a part of a character is never a pre-token
    encoded = tok.encode_batch_fast(strings, add_special_tokens=False)
    return frozenset(s for s, at, e in zip(strings, ids, encoded) if e.ids == [at])


class Counter:
    """One worker's counting state: normalizer table, whole tokens and memo."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.tok = load(path)
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        model = self.tok.model

        def encode(pretoken: str) -> list[int]:
            if pretoken in whole:
                return [0]
            return [0] * len(model.tokenize(pt.as_letters(pretoken)))

        self.memo = pt.Memo(encode)
        self.lower = np.full(0x300, 0x10FFFF, np.uint32)
        for cp in range(0x300):
            out = self.tok.normalizer.normalize_str(chr(cp))
            if len(out) == 1:
                self.lower[cp] = ord(out)

    def prepare(self, text: str) -> np.ndarray:
        """Normalized code points: by table if all have one, else by the library.

        Below U+0300 no character combines with another, so normalizing such a
        text is lower-casing each character.
        """
        cps = pt.code_points(text)
        if not len(cps) or cps.max() < 0x300:
            lowered = self.lower[cps]
            if not len(cps) or lowered.max() < 0x10FFFF:
                return lowered
        return pt.code_points(self.tok.normalizer.normalize_str(text))

    def count(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        fast = []
        for k, text in enumerate(texts):
            if any(s in text for s in self.specials):
                out[k] = len(self.tok.encode(text, add_special_tokens=False).ids)
            else:
                fast.append(k)
        window = pt.resolve([texts[k] for k in fast], "word", self.memo, self.prepare)
        sizes = np.diff(self.memo.ends)[window.slots]
        if fast:
            out[np.array(fast)] = np.bincount(window.doc_of, sizes, len(fast)).astype(np.int64)
        return out


_counters: dict[str, Counter] = {}


def counter(path: str, whole: frozenset[str]) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path, whole)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8) and ``n_tokens``.

    ``path`` names the vocabulary file, which every worker must be able to read.
    The whole-token set is bounded by the vocabulary and sent to the workers.
    """
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = counter(path, whole.value)
        for chunk in row_chunks(batches, "text", WINDOW_BYTES):
            texts = [t or "" for t in chunk.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("id"), chunk.column("n_bytes"), pa.array(state.count(texts))],
                ["id", "n_bytes", "n_tokens"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    given = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
    )
    return given.mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
