"""Byte-pair encoding of whole texts with a public vocabulary file, and decoding.

The vocabulary is of the kind that normalises to NFC, single spaces and lower case, and
ends each word with a marked symbol.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

#: Fixed values of the vocabulary's normaliser and word splitter.
SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
NOT_SPACE = re.compile("[\x1c-\x1f]")
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Stops after a letter or digit: a piece of their own, split off so that fewer words differ.
STOPS = re.compile(r"(?<=[^\W_])([.,]+)(?=\s|$)")

#: No merge.
NONE = np.iinfo(np.int32).max
#: Symbols of a word that is merged in a rank array; longer words use a heap.
SHORT = 48
#: Words whose encoding a worker keeps.
KEPT = 250_000
#: Texts whose words are looked up together.
AT_ONCE = 1000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(other)) for b in range(256)]


class WordBpe:
    """Encodes texts to token ids and decodes ids, as the vocabulary file says."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in special.items()}
        self.special = special
        named = "|".join(map(re.escape, sorted(special, key=len, reverse=True)))
        self.split_special = re.compile(f"({named})").split if special else lambda text: [text]
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int32)
        self.last = np.array([vocab[s + self.end] for s in symbols], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.size = max(self.tokens) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.young: dict[str, tuple[str, str]] = {}
        self.old: dict[str, tuple[str, str]] = {}

    def encode(self, text: str | None) -> list[int]:
        """Token ids of a whole text; null is empty."""
        ids = " ".join(entry[0] for entry in self._entries([text or ""])[0])
        return [int(i) for i in ids.split()]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space, special tokens and word ends included."""
        return " ".join(self.tokens[i] for i in ids)

    def encoded(self, texts: list[str | None]) -> Iterator[tuple[str, str]]:
        """For each text its ids, in decimal and joined by a space, and these decoded."""
        for i in range(0, len(texts), AT_ONCE):
            for entries in self._entries([t or "" for t in texts[i : i + AT_ONCE]]):
                yield " ".join([e[0] for e in entries]), " ".join([e[1] for e in entries])

    def _entries(self, texts: list[str]) -> list[list[tuple[str, str]]]:
        words = [self._words(text) for text in texts]
        fresh = {w for part in words for w in part if w not in self.young}
        known = {w: self.old[w] for w in fresh if w in self.old}
        known.update(self._learn([w for w in fresh if w not in known]))
        if len(self.young) + len(known) > KEPT:
            self.old, self.young = self.young, {}
            known.update((w, self.old[w]) for part in words for w in part if w in self.old)
        self.young.update(known)
        look_up = self.young
        return [[e for e in map(look_up.__getitem__, part) if e[0]] for part in words]

    def _words(self, text: str) -> list[str]:
        """Normalised words; a special token is a word of its own, kept as written."""
        parts = self.split_special(text)
        if len(parts) == 1:
            return self._plain_words(text)
        return [
            word
            for i, part in enumerate(parts)
            for word in ([part] if i % 2 else self._plain_words(part))
        ]

    @staticmethod
    def _plain_words(text: str) -> list[str]:
        normal = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        normal = STOPS.sub(r" \1", normal)
        if NOT_SPACE.search(normal):
            return [word for word in SPACE.split(normal) if word]
        return normal.split()

    def _learn(self, words: list[str]) -> dict[str, tuple[str, str]]:
        """The encoding of each word, by its pieces: a piece never holds a space."""
        parts = {
            word: [] if word in self.special else PIECE.findall(word) for word in words
        }
        pieces = list({piece for part in parts.values() for piece in part})
        ids = dict(zip(pieces, self._encode_pieces([p.encode("utf-8") for p in pieces])))
        found = {}
        for word, part in parts.items():
            own = [i for piece in part for i in ids[piece]]
            if word in self.special:
                own = [self.special[word]]
            found[word] = (" ".join(map(str, own)), self.decode(own))
        return found

    def _encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Pieces of like length are merged together, in arrays of one width."""
        found: list[list[int]] = [[] for _ in pieces]
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if len(piece) > SHORT:
                found[i] = self._merge_long(piece)
            else:
                by_width.setdefault(-(-len(piece) // 4) * 4, []).append(i)
        for width, rows in by_width.items():
            for i in range(0, len(rows), 8192):
                part = rows[i : i + 8192]
                for row, ids in zip(part, self._merge_short([pieces[r] for r in part], width)):
                    found[row] = ids
        return found

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NONE where there is none (or -1 for a part)."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[at], NONE)

    def _merge_short(self, pieces: list[bytes], width: int) -> list[list[int]]:
        """A row per piece holds its parts, and beside each the rank of merging it with the
        next. All rows step together: take the smallest rank, leftmost first, put the
        merged part in its place, close the gap, refresh the two ranks beside it."""
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        columns = np.arange(width + 1)
        rows = np.arange(len(pieces))
        parts = np.full((len(pieces), width + 1), -1, np.int32)
        parts[:, :width] = self.inner[raw.reshape(-1, width)]
        parts[rows, size - 1] = self.last[raw.reshape(-1, width)[rows, size - 1]]
        parts[columns >= size[:, None]] = -1
        ranks = np.full((len(pieces), width + 1), NONE, np.int32)
        ranks[:, :width] = self._rank(parts[:, :-1], parts[:, 1:])
        done: list[list[int]] = [[] for _ in pieces]
        while len(rows):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            for r in np.flatnonzero(best == NONE).tolist():
                done[rows[r]] = [i for i in parts[r].tolist() if i >= 0]
            left = best < NONE
            rows, at, best, parts, ranks = rows[left], at[left], best[left], parts[left], ranks[left]
            if not len(rows):
                break
            every = np.arange(len(rows))
            shifted = np.minimum(columns + (columns > at[:, None]), width)
            parts = np.take_along_axis(parts, shifted, 1)
            ranks = np.take_along_axis(ranks, shifted, 1)
            parts[every, at] = self.merged[best]
            ranks[every, at] = self._rank(parts[every, at], parts[every, np.minimum(at + 1, width)])
            inner = np.flatnonzero(at > 0)
            before = at[inner] - 1
            ranks[inner, before] = self._rank(parts[inner, before], parts[inner, at[inner]])
        return done

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same merges with a heap, for words too long to scan again and again."""
        parts = self.inner[np.frombuffer(piece, np.uint8)]
        parts[-1] = self.last[piece[-1]]
        ranks = self._rank(parts[:-1], parts[1:])
        heap = [(int(r), i) for i, r in enumerate(ranks) if r < NONE]
        heapq.heapify(heap)
        parts = parts.tolist()
        following = [*range(1, len(parts)), -1]
        previous = [*range(-1, len(parts) - 1)]
        current = {i: int(r) for i, r in enumerate(ranks) if r < NONE}
        while heap:
            rank, i = heapq.heappop(heap)
            if current.get(i) != rank:
                continue
            gone = following[i]
            parts[i], parts[gone] = int(self.merged[rank]), -1
            current.pop(gone, None)
            following[i] = following[gone]
            if following[i] >= 0:
                previous[following[i]] = i
            for a, b in ((previous[i], i), (i, following[i])):
                if a < 0 or b < 0:
                    current.pop(a, None) if b < 0 else None
                    continue
                key = parts[a] * self.size + parts[b]
                at = min(int(np.searchsorted(self.keys, key)), len(self.keys) - 1)
                if self.keys[at] == key:
                    current[a] = int(self.ranks[at])
                    heapq.heappush(heap, (current[a], a))
                else:
                    current.pop(a, None)
        return [i for i in parts if i >= 0]


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    """One tokenizer per worker and file, so its words are merged once."""
    return WordBpe(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = tokenizer(path)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": [bpe.encode(t) for t in batch["text"]]})

    rows = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def round_trip(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row's whole text.

    The digests are of the ids in decimal, joined by a space, and of the decoded text.
    A null text is empty: no tokens, and the digests of an empty text. Rows are
    independent; repeated rows give repeated results.
    """

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8")).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = tokenizer(path)
        for batch in batches:
            rows = [
                (ids.count(" ") + 1 if ids else 0, digest(ids), digest(decoded))
                for ids, decoded in bpe.encoded(batch["text"].tolist())
            ]
            found = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            found.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield found

    rows = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text")
    return rows.mapInPandas(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
