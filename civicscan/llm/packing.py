"""Concatenate-and-cut packing of token sequences.

Pass 1 tokenizes each partition once and writes, with the ids, where each
document starts in its partition's token stream.  The partitions' token totals
(one row per partition) become global offsets by a prefix sum.  Pass 2 cuts
the global stream into windows of a fixed length by arithmetic on those
offsets; a document that crosses window ends gets a record per window.
"""

from __future__ import annotations

import hashlib
import os
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicscan.llm.common import materialize, ship_package, worker_state

SEQUENCE_TOKENS = 4096
END_ID = 2
#: Partitions whose token totals are summed in one task.
GROUP = 1024
#: Words kept per Python worker in each of two tables: a full one becomes the
#: old one, from which words still in use are taken over.
CACHE_WORDS = 350_000
#: Characters of texts whose new words are learned together.
TOGETHER = 1 << 21

# str.split() also splits at U+001C..U+001F, which the vocabulary's white space does not include
_CONTROL = "\x1c\x1d\x1e\x1f"

# of these the vocabulary makes one word of a run; they compose with no letter
_MARKS = string.punctuation

# bytes outside printable ASCII and Latin-1 stand in a vocabulary for characters from U+0100 on, in order
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_SHOWN = {b: 256 + i for i, b in enumerate(_HIDDEN)}


_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]


class WordTokenizer:
    """Ids of whole texts for a vocabulary that drops white space and never
    joins text over it, so a text's ids are those of its words in turn."""

    def __init__(self, data: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(data.decode())
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.merges = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, word: str) -> bytes:
        """Ids of a lower-case word of letters up to U+00FF: one word of the
        vocabulary's split, so only the merges are left to apply."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_SHOWN)
        return _PACK[n](*ids) if (n := len(ids := [t.id for t in self.merges.tokenize(word)])) < len(_PACK) else struct.pack(f"<{n}I", *ids)

    def _learn(self, missing: set[str]) -> None:
        words, old, others = self.words, self.old, []
        for w in missing:
            if w in old:
                words[w] = old[w]
                continue
            # marks after a word are a word of their own: "word,--" is "word" and ",--"
            head = w.rstrip(_MARKS)
            # the head's own letters decide, whatever earlier rows have put in the table
            if not (head.isalpha() and head.islower() and (head.isascii() or max(head) <= "\xff")):
                others.append(w)
                continue
            ids = words.get(head)
            if ids is None:
                ids = words[head] = self._letters(head)
            if len(head) < len(w):
                mark = w[len(head):]
                if mark not in words:
                    words[mark] = self._encode([mark])[0]
                words[w] = ids + words[mark]
        words.update(zip(others, self._encode(others)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text; new words are learned for many texts at once."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            end, size = at + 1, len(texts[at])
            while end < len(texts) and size + len(texts[end]) <= TOGETHER:
                size += len(texts[end])
                end += 1
            out += self._together(texts[at:end])
            at = end
        return out

    def _together(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = []
        later: list[tuple[int, list, list[tuple[int, str]]]] = []
        known, missing = self.words.get, set()
        for i, t in enumerate(texts):
            if any(c in t for c in _CONTROL):
                out.append(self._encode([t])[0])
                continue
            if t.isascii():
                t = t.lower()
            else:
                try:  # up to U+00FF lower-casing is the same letter by letter and in context
                    t.encode("latin-1")
                    t = t.lower()
                except UnicodeEncodeError:
                    pass
            words = t.split()
            ids = list(map(known, words))
            if None in ids:
                gaps = [(k, words[k]) for k, x in enumerate(ids) if x is None]
                missing.update([w for _, w in gaps])
                later.append((i, ids, gaps))
                out.append(None)
            else:
                out.append(b"".join(ids))
        if later:
            if len(self.words) > CACHE_WORDS:
                self.old, self.words = self.words, {}
            self._learn(missing)
            for i, ids, gaps in later:
                for k, w in gaps:
                    ids[k] = self.words[w]
                out[i] = b"".join(ids)
        return out


def _loaded(data: bytes) -> WordTokenizer:
    return worker_state(("packing", hashlib.sha256(data).hexdigest()), lambda: WordTokenizer(data))


def tokenized(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = END_ID) -> DataFrame:
    """Pass 1, written to the shared folder: ``part, id, local_start, n_tokens, ids``
    (32-bit little-endian ids with ``end_id`` last)."""
    ship_package(df.sparkSession)
    with open(vocabulary, "rb") as f:
        data = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = 0
        tail = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                texts = [t.decode("utf-8", "replace") if t else "" for t in rows.column(2).to_pylist()]
                ids = [x + tail for x in _loaded(data).encode(texts)]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                local = start + np.cumsum(n) - n
                start += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(local), pa.array(n), pa.array(ids, pa.binary())],
                    names=["part", "id", "local_start", "n_tokens", "ids"])

    rows = df.select(F.spark_partition_id().alias("part"), F.col(id_col).cast("long").alias("id"),
                     F.col(text_col).cast("binary").alias("t"))
    return materialize(rows.mapInArrow(run, "part int, id long, local_start long, n_tokens long, ids binary"), "packing-ids")


def pack(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
         length: int = SEQUENCE_TOKENS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and the piece's ids on request).

    All sequences hold exactly ``length`` ids but the last.  A null or empty
    text is the end id alone.  Repeated rows are packed each on their own, null
    ids are kept, an empty table gives no piece, other columns are not looked
    at.
    """
    ids = tokenized(df, vocabulary, id_col, text_col, end_id)
    total = ids.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # prefix sums in two levels: inside groups of partitions, then over the groups
    total = materialize(total.withColumn("g", F.floor(F.col("part") / GROUP)), "packing-totals")
    groups = total.groupBy("g").agg(F.sum("total").alias("m"))
    groups = groups.select("g", (F.sum("m").over(Window.orderBy("g")) - F.col("m")).alias("before"))
    inside = F.sum("total").over(Window.partitionBy("g").orderBy("part")) - F.col("total")
    base = total.withColumn("inside", inside).join(groups, "g").select("part", (F.col("before") + F.col("inside")).alias("base"))
    rows = ids.join(base, "part").select(
        "id", (F.col("base") + F.col("local_start")).alias("at"), "n_tokens", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
        for batch in batches:
            for b in range(0, batch.num_rows, 256):
                part = batch.slice(b, 256)
                at, n = part.column(1).to_numpy(), part.column(2).to_numpy()
                pieces = (at + n - 1) // length - at // length + 1
                doc = np.repeat(np.arange(len(n)), pieces)
                k = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                sequence = at[doc] // length + k
                lo = np.maximum(sequence * length, at[doc])
                hi = np.minimum((sequence + 1) * length, at[doc] + n[doc])
                start = lo - at[doc]
                texts = part.column(3).to_pylist()
                cut = [texts[d][4 * s:4 * e] for d, s, e in zip(doc.tolist(), start.tolist(), (hi - at[doc]).tolist())]
                out = [part.column(0).take(pa.array(doc)), pa.array(start), pa.array(hi - lo),
                       pa.array([zlib.crc32(c) for c in cut], pa.int64()), pa.array(n[doc]), pa.array(sequence),
                       pa.array(lo - sequence * length)]
                if with_ids:
                    out.append(pa.array([np.frombuffer(c, "<u4").tolist() for c in cut], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, names=names)

    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
