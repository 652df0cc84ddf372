"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

The encoder takes from the tokenizer file its normalizer, its splitting and its
merge list, and replaces the merge loop. For a piece (the symbols of one split),
the encoding of every prefix ends in a unique token; that token is the one
vocabulary entry which

* matches a suffix of the prefix (an automaton over all vocabulary entries with
  suffix links gives these matches while it reads the piece once), and
* is compatible with the last token of what remains: merging the two tokens'
  symbols by the ranked merges gives just the two tokens again. Merging stays
  inside the two exactly if no pair that meets at their border, on the way
  from symbols to tokens, ranks before what would absorb one of the pair.

So for every prefix one token is stored, and following these back-pointers from
the whole piece gives the ids of the library's merge loop, in time linear in the
piece times the few matching suffixes. Pair tests are remembered, pieces too, in
tables of bounded size.

Defined cases: a null or empty text has no ids and decodes to the empty text;
special-token strings inside a text are that token, as in the library; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.llm.common import id_text, map_pandas
from quakeframe.llm.tokens import _ODD, byte_letters, comparable, latin, load_tokenizer, split_tail


class SuffixAutomaton:
    """Trie of token spellings (tuples of symbol numbers) with suffix links;
    ``found[state]`` lists the tokens that end there, longest first."""

    def __init__(self, spellings: dict[int, tuple[int, ...]]):
        self.next: list[dict[int, int]] = [{}]
        self.own: list[int] = [-1]
        self.depth: list[int] = [0]
        for token, spelling in spellings.items():
            state = 0
            for symbol in spelling:
                after = self.next[state].get(symbol)
                if after is None:
                    after = self.next[state][symbol] = len(self.next)
                    self.next.append({})
                    self.own.append(-1)
                    self.depth.append(self.depth[state] + 1)
                state = after
            self.own[state] = token
        self.link = [0] * len(self.next)
        self.hit = [0] * len(self.next)  # the nearest state on the links that ends a token
        queue = list(self.next[0].values())
        for state in queue:
            for symbol, after in self.next[state].items():
                back = self.link[state]
                while back and symbol not in self.next[back]:
                    back = self.link[back]
                self.link[after] = self.next[back].get(symbol, 0)
                queue.append(after)
            back = self.link[state]
            self.hit[state] = back if self.own[back] >= 0 else self.hit[back]
        self.found = [self.ends(state) for state in range(len(self.next))]

    def ends(self, state: int) -> list[tuple[int, int]]:
        """(token, its number of symbols) of the tokens that end in this state."""
        out = []
        at = state if self.own[state] >= 0 else self.hit[state]
        while at:
            out.append((self.own[at], self.depth[at]))
            at = self.hit[at]
        return out


class PrefixEncoder:
    """Encodes pieces; ``most`` bounds every table that grows with the input."""

    def __init__(self, path: str, most: int = 500_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError("only plain ranked-merge models are supported")
        if spec.get("decoder") is not None:
            raise ValueError("only files without a decoder are supported: words are joined by spaces")
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("only special tokens that match as they are are supported")
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = {i: w for w, i in self.vocab.items()} | {i: w for w, i in self.special.items()}
        tokenizer = load_tokenizer(path)
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        spelling: dict[int, tuple[int, ...]] = {}
        made = {a + b for a, b in merges}
        for word, token in self.vocab.items():
            if word not in made:
                spelling[token] = (token,)
        for rank, (a, b) in enumerate(merges):
            left, right, both = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.ranks.setdefault((left, right), (rank, both))
            if both not in spelling:
                spelling[both] = spelling[left] + spelling[right]
        self.spelling = spelling
        # For a learned list every merge ranks after those that made its parts,
        # and a token is made in one way; else the merge loop decides.
        made_by = {both: (rank, left, right) for (left, right), (rank, both) in self.ranks.items()}
        self.learned = len(made_by) == len(self.ranks) and all(
            rank > max(made_by.get(left, (-1,))[0], made_by.get(right, (-1,))[0]) for rank, left, right in made_by.values()
        )
        self.made_by = made_by
        self.edges: tuple[dict, dict] = ({}, {})
        self.rank_of = {left << 20 | right: rank for (left, right), (rank, _) in self.ranks.items()}
        # A token that its own symbols don't merge into is never the result.
        self.automaton = SuffixAutomaton({t: s for t, s in spelling.items() if len(s) == 1 or self.merge(s) == [t]})
        self.most, self.pairs, self.chunks = most, {}, {}
        self.direct = self._passes_letters()

    def merge(self, symbols: tuple[int, ...]) -> list[int]:
        """The ranked merge loop; used on two tokens at a time only."""
        row = list(symbols)
        while len(row) > 1:
            best = min(((self.ranks[p][0], i) for i, p in enumerate(zip(row, row[1:], strict=False)) if p in self.ranks), default=None)
            if best is None:
                break
            i = best[1]
            row[i : i + 2] = [self.ranks[row[i], row[i + 1]][1]]
        return row

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that stand at the right (0) or left (1) edge of ``token`` while
        it is made, first its symbol, each with the rank of the merge that
        absorbs it; the token itself is never absorbed."""
        got = self.edges[side].get(token)
        if got is None:
            got, rank = [], float("inf")
            while True:
                got.append((token, rank))
                if token not in self.made_by:
                    break
                rank, left, right = self.made_by[token]
                token = left if side else right
            got.reverse()
            self.edges[side][got[-1][0]] = got
        return got

    def _stays_apart(self, left: int, right: int) -> bool:
        a, b, i, j = self.edge(left, 0), self.edge(right, 1), 0, 0
        while True:
            (x, x_gone), (y, y_gone) = a[i], b[j]
            rank = self.rank_of.get(x << 20 | y)
            # Of equal merges the left one comes first.
            if rank is not None and rank < x_gone and rank <= y_gone:
                return False
            if x_gone <= y_gone:
                if i + 1 == len(a):
                    return True
                i += 1
            else:
                j += 1

    def compatible(self, left: int, right: int) -> bool:
        key = left << 20 | right
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) >= self.most:
                self.pairs.clear()
            if self.learned:
                got = self._stays_apart(left, right)
            else:
                got = self.merge(self.spelling[left] + self.spelling[right]) == [left, right]
            self.pairs[key] = got
        return got

    def symbols(self, piece: str) -> list[int]:
        vocab = self.vocab
        return [vocab[c] for c in piece[:-1]] + [vocab[piece[-1] + self.end]]

    def encode_piece(self, piece: str) -> list[int]:
        follow, link, found = self.automaton.next, self.automaton.link, self.automaton.found
        pairs = self.pairs
        state, n, last, sizes = 0, 0, [], []
        for symbol in self.symbols(piece):
            after = follow[state].get(symbol)
            while after is None and state:
                state = link[state]
                after = follow[state].get(symbol)
            state = after or 0
            n += 1
            for token, size in found[state]:
                if size == n:
                    break
                left = last[n - size - 1]
                ok = pairs.get(left << 20 | token)
                if ok if ok is not None else self.compatible(left, token):
                    break
            last.append(token)
            sizes.append(size)
        ids = []
        while n:
            ids.append(last[n - 1])
            n -= sizes[n - 1]
        ids.reverse()
        return ids

    def encode_plain(self, text: str) -> list[int]:
        """Text without special tokens."""
        text = self.normalizer.normalize_str(text) if self.normalizer else text
        out: list[int] = []
        for piece, _ in self.splitter.pre_tokenize_str(text):
            out += self.encode_piece(piece)
        return out

    def encode_chunk(self, chunk: str) -> list[int]:
        if self.cut is None or not self.cut.search(chunk):
            return self.encode_plain(chunk)
        out: list[int] = []
        for part in self.cut.split(chunk):
            out += [self.special[part]] if part in self.special else self.encode_plain(part) if part else []
        return out

    def _passes_letters(self) -> bool:
        """Whether letters alone are one piece, lower-cased."""
        for w in ("straße", "éàÿ", "Word", "ªº"):
            text = self.normalizer.normalize_str(w) if self.normalizer else w
            if [p for p, _ in self.splitter.pre_tokenize_str(text)] != [byte_letters(w.lower())]:
                return False
        return True

    def chunk(self, chunk: str) -> tuple[int, str, str]:
        """Number of ids, the ids in decimal, the decoded words; each joined by
        spaces. The tokenizer file has no decoder, so decoding joins words so."""
        got = self.chunks.get(chunk)
        if got is None:
            cut = split_tail(chunk)
            if cut < len(chunk):
                a, b = self.chunk(chunk[:cut]), self.chunk(chunk[cut:])
                return a[0] + b[0], f"{a[1]} {b[1]}", f"{a[2]} {b[2]}"
            if self.direct and chunk.isalpha() and latin(chunk):
                ids = self.encode_piece(byte_letters(chunk.lower()))
            else:
                ids = self.encode_chunk(chunk)
            if len(self.chunks) >= self.most:
                self.chunks.clear()
            words = self.words
            got = self.chunks[chunk] = (len(ids), " ".join(map(str, ids)), " ".join([words[i] for i in ids]))
        return got

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text. Splits never cross white space."""
        return list(map(int, self.encode_and_decode(text)[1].split()))

    def encode_and_decode(self, text: str) -> tuple[int, str, str]:
        """(number of ids, ids in decimal, decoded text)."""
        if _ODD.search(text):
            ids = self.encode_chunk(text)
            return len(ids), " ".join(map(str, ids)), self.decode(ids)
        known = self.chunks.get
        parts = [known(c) or self.chunk(c) for c in comparable(text).split()]
        # A stretch of which the splitting leaves nothing has no ids.
        parts = [p for p in parts if p[0]]
        return sum([p[0] for p in parts]), " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts])

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.words[i] for i in ids])


_ENCODERS: dict[str, PrefixEncoder] = {}


def prefix_encoder(path: str) -> PrefixEncoder:
    """One encoder per worker process; its tables serve all tasks that follow."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PrefixEncoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids) of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = prefix_encoder(tokenizer)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "ids": [enc.encode(t) for t in b["text"]]})

    return map_pandas(id_text(docs), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = prefix_encoder(tokenizer)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "text": [enc.decode(list(x)) for x in b["ids"]]})

    return map_pandas(encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids"), run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, then decode, in one
    pass, so that ids and texts needn't leave the task."""

    def sha(s: str) -> str:
        return hashlib.sha256(s.encode()).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = prefix_encoder(tokenizer)
        for b in batches:
            rows = [enc.encode_and_decode(t) for t in b["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": b["doc_id"].astype("Int64"),
                    "n_tokens": [r[0] for r in rows],
                    "ids_sha256": [sha(r[1]) for r in rows],
                    "decoded_sha256": [sha(r[2]) for r in rows],
                }
            )

    return map_pandas(id_text(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
