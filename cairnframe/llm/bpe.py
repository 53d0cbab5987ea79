"""Byte-pair encoding with a pair occurrence index, and decoding (operator 7).

The words of a batch that the task has not met yet are laid out in one array of symbols. An index
maps each pair of neighbours that has a merge to all its positions; active ranks are taken in
ascending order from a heap, all positions of a rank's pair are merged from left to right, and the
lists of the pairs that this makes are updated. What words give is kept for later batches of the
task in a cache of bounded size. Vocabulary files are public and are read from a path on each
executor; nothing is trained.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import text_batches

#: Words in a task's cache; when it is full, it becomes the older of two, and only words that are met again move on.
CACHE_WORDS = 300_000
#: Bits for an id where two share a number.
SHIFT = 20
MASK = (1 << SHIFT) - 1
#: Texts of these characters alone need no library call: no Unicode version splits, folds or composes them otherwise.
PLAIN = regex.compile(r"[\t\n\r\x20-\x7e\xa1-įı-ɏ‐-‧‰-⁞]*+")


def default_vocabulary() -> str:
    """Where the installed public tokenizer files have this vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordBpe:
    """A vocabulary of BPE with word ends; `encode_words` is the pair occurrence index."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        # A pair of symbols is one number, and so is a merge: its rank and what it makes.
        self.merge = {self.ids[a] << SHIFT | self.ids[b]: rank << SHIFT | self.ids[a + b] for rank, (a, b) in enumerate(pairs) if a in self.ids and b in self.ids}
        self.pair_of = {merge >> SHIFT: pair for pair, merge in self.merge.items()}
        self.pairs = np.array(sorted(self.merge), np.int64)
        self.start = {c: i for c, i in self.ids.items() if len(c) == 1}
        self.end = {c: self.ids[c + self.suffix] for c in self.start if c + self.suffix in self.ids}
        self.bytes = byte_characters()
        self.library = Tokenizer.from_str(json.dumps(spec | {"truncation": None, "padding": None}))
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.cache: dict[str | int, tuple[int, bytes, str]] = {}
        self.older: dict[str | int, tuple[int, bytes, str]] = {}

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each byte-level word (its bytes as printable characters)."""
        symbols: list[int] = []
        after: list[int] = []
        first: list[int] = []
        start, last = self.start, self.end
        for word in words:
            first.append(len(symbols))
            symbols += [start[c] for c in word[:-1]]
            symbols.append(last[word[-1]])
            after += range(len(after) + 1, len(symbols))
            after.append(-1)
        before = [-1] + [p if n >= 0 else -1 for p, n in enumerate(after[:-1])]
        merge, pair_of = self.merge, self.pair_of
        # The index as it starts: the pairs that have a merge, each with its positions from left to right.
        laid = np.array(symbols, np.int64)
        keys = laid[:-1] << SHIFT | laid[1:]
        at = np.flatnonzero((np.array(after[:-1]) >= 0) & (self.pairs[np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)] == keys))
        at = at[np.argsort(keys[at], kind="stable")]
        cuts = np.flatnonzero(np.diff(keys[at])) + 1
        index: dict[int, list[int]] = {int(keys[x[0]]): x.tolist() for x in np.split(at, cuts) if len(x)}
        ranks = [merge[pair] >> SHIFT for pair in index]
        heapq.heapify(ranks)
        while ranks:
            pair = pair_of[heapq.heappop(ranks)]
            positions = index.pop(pair)
            left, right = pair >> SHIFT, pair & MASK
            made = merge[pair] & MASK
            positions.sort()
            for p in positions:
                n = after[p]
                if symbols[p] != left or n < 0 or symbols[n] != right:
                    continue  # an earlier merge took one of the two
                symbols[p], symbols[n] = made, -1
                after[p] = n = after[n]
                b = before[p]
                if n >= 0:
                    before[n] = p
                    if (new := made << SHIFT | symbols[n]) in merge:
                        if new in index:
                            index[new].append(p)
                        else:
                            index[new] = [p]
                            heapq.heappush(ranks, merge[new] >> SHIFT)
                if b >= 0 and (new := symbols[b] << SHIFT | made) in merge:
                    if new in index:
                        index[new].append(b)
                    else:
                        index[new] = [b]
                        heapq.heappush(ranks, merge[new] >> SHIFT)
        out = []
        for p in first:
            ids = []
            while p >= 0:
                ids.append(symbols[p])
                p = after[p]
            out.append(ids)
        return out

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens; they are kept as plain strings."""
        if PLAIN.fullmatch(text):
            return self.split.findall(text.lower())
        whole = self.library.normalizer.normalize_str(text)
        return ["\0" + w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(whole)]

    def pieces(self, text: str) -> list[str | int]:
        """Words, and the ids of special tokens that stand in the text itself."""
        if self.specials is None or not self.specials.search(text):
            return self.words(text)
        out: list[str | int] = []
        at = 0
        for m in self.specials.finditer(text):
            out += self.words(text[at : m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + self.words(text[at:])

    def byte_level(self, word: str) -> str:
        """Words that the library split are marked and byte-level already."""
        return word[1:] if word[0] == "\0" else "".join([self.bytes[b] for b in word.encode("utf-8")])

    def encode_batch(self, texts: list[str]) -> list[list[tuple[int, bytes, str]]]:
        """For each text its words' (number of ids, ids in decimal, decoded tokens)."""
        split = [self.pieces(t) for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache, self.older = {}, self.cache
        cache, older, new = self.cache, self.older, []
        for w in {w for words in split for w in words if w not in cache}:
            if w in older:
                cache[w] = older[w]
            else:
                new.append(w)
        for k in range(0, len(new), CACHE_WORDS):
            block = new[k : k + CACHE_WORDS]
            plain = [w for w in block if isinstance(w, str)]
            for w, ids in zip(plain, plain and self.encode_words([self.byte_level(w) for w in plain]), strict=True):
                cache[w] = (len(ids), " ".join(map(str, ids)).encode(), " ".join([self.tokens[i] for i in ids]))
            for w in block:
                if isinstance(w, int):
                    cache[w] = (1, str(w).encode(), self.tokens[w])
        return [[cache[w] for w in words] for words in split]

    def encode(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in self.encode_batch([text])[0] for i in ids.split()]

    def decode(self, ids: list[int]) -> str:
        """As the library does without a decoder: tokens joined by one space, special ones too."""
        return " ".join([self.tokens[i] for i in ids])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


def bpe_round_trip(docs: DataFrame, path: str | None = None, with_ids: bool = False, keep: list[str] | None = None) -> DataFrame:
    """(keep columns, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) for each row of `docs`.

    `docs` has text and the columns in `keep` (doc_id unless given). Null and empty texts have no
    tokens and the digests of the empty string. Repeated rows stay. Any text length is encoded
    whole; an empty table gives no rows. With `with_ids` the ids and the decoded text come too.
    """
    keep, path = keep or ["doc_id"], path or default_vocabulary()
    text_batches(docs.sparkSession)
    fields = [docs.schema[c] for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        sha = hashlib.sha256
        for batch in batches:
            n, ids, decoded, more = [], [], [], ([], [])
            for words in bpe.encode_batch([t or "" for t in batch.column("__text").to_pylist()]):
                n.append(sum([w[0] for w in words]))
                digits, text = b" ".join([w[1] for w in words]), " ".join([w[2] for w in words])
                ids.append(sha(digits).hexdigest())
                decoded.append(sha(text.encode()).hexdigest())
                if with_ids:
                    more[0].append([int(i) for i in digits.split()])
                    more[1].append(text)
            columns = [*(batch.column(c) for c in keep), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            columns += [pa.array(more[0], pa.list_(pa.int32())), pa.array(more[1], pa.string())] if with_ids else []
            names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if with_ids else [])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(*(F.col(f"`{c}`") for c in keep), F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)
