"""Byte-level BPE encoding and decoding of whole texts.

Encoder: the text is cut into words by the vocabulary's split pattern.  In a
word an Aho-Corasick automaton gives the longest token at each position; a
token is taken if it is compatible with its left neighbour, that is, if
merging the two tokens' bytes by rank never joins symbols across their
boundary.  Where it isn't, the next shorter prefix token is tried, and a
position from which nothing fits is marked dead and left by backtracking.
Each (position, token) is tried once, so time is linear in the word, and the
result is the one sequence whose neighbours are all compatible: exactly what
applying the merges in rank order gives.

Decoder: one buffer holds the bytes of all tokens; an offset table says where
each begins.
"""

from __future__ import annotations

import hashlib
import json
from math import inf

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicscan.llm.common import map_arrow, worker_state

#: Words kept per Python worker; a full table is emptied.
CACHE_WORDS = 300_000

# The split pattern of byte-level vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """Printable characters of the vocabulary file stand for their own byte,
    characters from U+0100 on for the other bytes in ascending order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Bpe:
    """Encoder and decoder of one byte-level vocabulary (the content of its JSON file)."""

    def __init__(self, data: bytes) -> None:
        spec = json.loads(data)
        byte = _byte_of_char()
        raw = {t: bytes(byte[c] for c in t) for t in spec["model"]["vocab"]}
        ids = {raw[t]: i for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max(*ids.values(), *self.special.values())
        self.bytes_of = [b""] * size
        for b, i in ids.items():
            self.bytes_of[i] = b
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode()
        self.length = [len(b) for b in self.bytes_of]
        self.offset = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(self.bytes_of), np.uint8)

        self.rank: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {}  # id -> left, right, rank
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            left, right = ids[raw[a]], ids[raw[b]]
            self.rank[left, right] = r
            made.setdefault(ids[raw[a] + raw[b]], (left, right, r))
        self._right = self._spines(made, 1)
        self._left = self._spines(made, 0)
        # a token that its own merges never reach can't occur in an encoding
        usable = {i for i in ids.values() if i not in made or self._crossing(*made[i][:2]) == made[i][2]}
        self.automaton = ahocorasick.Automaton()
        for b, i in ids.items():
            if i in usable:
                self.automaton.add_word(b.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.shorter = [-1] * size
        for b, i in ids.items():
            self.shorter[i] = next((ids[b[:n]] for n in range(len(b) - 1, 0, -1) if ids.get(b[:n]) in usable), -1)
        self._fits: dict[int, bool] = {}
        self._width = size
        self._words: dict[str, bytes] = {}
        self._chunks: dict[str, bytes | None] = {}
        self._split = regex.compile(PATTERN)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.type = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")

    @staticmethod
    def _spines(made: dict, side: int) -> dict[int, list[tuple[int, float]]]:
        """For each token the symbols at its right (or left) edge from byte to
        token, each with the rank of the merge that consumes it."""
        out: dict[int, list[tuple[int, float]]] = {}

        def spine(t: int) -> list[tuple[int, float]]:
            chain, until = [], inf
            while True:
                chain.append((t, until))
                if t not in made:
                    return chain[::-1]
                t, until = made[t][side], made[t][2]

        for t in made:
            out[t] = spine(t)
        return out

    def _crossing(self, a: int, b: int) -> int | None:
        """Rank of the first merge over the boundary of tokens a and b, None if there is none."""
        left, right = self._right.get(a, [(a, inf)]), self._left.get(b, [(b, inf)])
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            r = self.rank.get((x, y))
            # of equal merges the leftmost is applied first
            if r is not None and r < x_until and r <= y_until:
                return r
            if x_until == y_until == inf:
                return None
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def _compatible(self, a: int, b: int) -> bool:
        key = a * self._width + b
        ok = self._fits.get(key)
        if ok is None:
            if len(self._fits) > 4 * CACHE_WORDS:
                self._fits.clear()
            ok = self._fits[key] = self._crossing(a, b) is None
        return ok

    def encode_word(self, word: str) -> list[int]:
        """Token ids of one word, given with one character per byte."""
        longest = self.automaton.iter_long
        path: list[int] = []
        length, at, n, dead = self.length, 0, len(word), set()
        known = {end + 1 - length[t]: t for end, t in longest(word)}
        token = known[0] if n else -1
        while at < n:
            end = at + length[token]
            if end not in dead and (not path or self._compatible(path[-1], token)):
                path.append(token)
                at = end
                if at < n:
                    token = known.get(at)
                    if token is None:
                        token = known[at] = next(longest(word, at))[1]
                continue
            token = self.shorter[token]
            while token < 0:
                dead.add(at)
                token = path.pop()
                at -= length[token]
                token = self.shorter[token]
        return path

    def _word(self, word: str) -> bytes:
        got = self._words.get(word)
        if got is None:
            if len(self._words) > CACHE_WORDS:
                self._words.clear()
            ids = self.encode_word(word.encode("utf-8", "replace").decode("latin-1"))
            got = self._words[word] = np.array(ids, self.type).tobytes()
        return got

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self._word, self._split.findall(text)))

    def _chunk(self, chunk: str) -> bytes | None:
        """Ids of a run of text between spaces, after a space unless it starts
        a line; None if white space in it may change how its neighbours split."""
        body = chunk[1:] if chunk[:1] == "\n" else chunk
        out = None
        if body and len(body.split()) == 1 and body == body.strip():
            out = self._plain(chunk if chunk[0] == "\n" else " " + chunk)
        if len(self._chunks) > CACHE_WORDS:
            self._chunks.clear()
        self._chunks[chunk] = out
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; strings of special tokens become their ids."""
        if self._cut and any(s in text for s in self.special):
            parts = [np.array([self.special[p]], self.type).tobytes() if p in self.special else self._plain(p)
                     for p in self._cut.split(text) if p]
            return np.frombuffer(b"".join(parts), self.type)
        # words mostly stand between single spaces or newlines: look those up whole
        chunks = text.replace("\n", " \n").split(" ")
        first, get = chunks[0], self._chunks.get
        if first and len(first.split()) == 1 and first == first.strip():
            parts = [get(c) or self._chunk(c) for c in chunks[1:]]
            if None not in parts:
                return np.frombuffer(self._plain(first) + b"".join(parts), self.type)
        return np.frombuffer(self._plain(text), self.type)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' bytes one after the other, by the offset table."""
        start = self.offset[ids]
        size = self.offset[ids.astype(np.int64) + 1] - start
        end = np.cumsum(size)
        at = np.arange(end[-1] if len(end) else 0, dtype=np.int64)
        return self.blob[at + np.repeat(start - (end - size), size)].tobytes()


def loaded(data: bytes) -> Bpe:
    """The worker's encoder for this vocabulary, built once."""
    return worker_state(("bpe", hashlib.sha256(data).hexdigest()), lambda: Bpe(data))


_DECODE_BLOCK = 1 << 20


def round_trip(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
               with_ids: bool = False) -> DataFrame:
    """Encode every text and decode it again.

    Returns id, n_tokens, ids_sha256 (decimal ids joined by commas) and
    decoded_sha256 (of the decoded UTF-8 text), with ``ids array<int>`` on
    request.  ``vocabulary`` is the path of the vocabulary file on the driver;
    its content travels with the job.  A null text counts as empty (no
    tokens); repeated rows and null ids are returned as they come; an empty
    table gives an empty result; other columns are not looked at.
    """
    with open(vocabulary, "rb") as f:
        data = f.read()

    def run(c):
        bpe = loaded(data)
        out: dict[str, list] = {"id": c["id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        if with_ids:
            out["ids"] = []
        for t in c["t"]:
            ids = bpe.encode(t.decode("utf-8", "replace") if t else "")
            out["n_tokens"].append(len(ids))
            listed, text = hashlib.sha256(), hashlib.sha256()
            tail = b""
            for at in range(0, len(ids), _DECODE_BLOCK):
                part = ids[at:at + _DECODE_BLOCK]
                listed.update((("," if at else "") + ",".join(map(str, part.tolist()))).encode())
                tail += bpe.decode(part)
                # a character may be cut between tokens: whole texts decode leniently, so only hash whole characters
                keep = next((len(tail) - k for k in range(1, min(4, len(tail)) + 1) if tail[-k] >= 0xC0), len(tail)) if at + _DECODE_BLOCK < len(ids) else len(tail)
                text.update(tail[:keep].decode("utf-8", "replace").encode())
                tail = tail[keep:]
            out["ids_sha256"].append(listed.hexdigest())
            out["decoded_sha256"].append(text.hexdigest())
            if with_ids:
                out["ids"].append(ids.tolist())
        out["id"] = pa.array(c["id"], pa.int64())
        return out

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    return map_arrow(rows, run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
                     + (", ids array<int>" if with_ids else ""))
