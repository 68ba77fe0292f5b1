"""BPE encoding by prefix-sharing trie traversal, and decoding.

The words of a batch go into a trie whose edges are byte signs (the last one with the word end). A depth-first walk gives
every node its state: the last token of the encoding of the prefix that ends there, and the node where that token begins.
The last token is the longest suffix token that stays apart from the last token before it, so states follow from states
nearer to the root, and a prefix shared by words is encoded once. Encodings are read off by following the states back.

Null text counts as empty (no tokens). Each row is encoded by itself; memory per task is bounded by ``max_nodes``.
"""
from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from contextlib import contextmanager
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
#: Bounds of the memory of a task: nodes of the trie, and pairs of tokens.
MAX_NODES, MAX_PAIRS = 1_000_000, 1_000_000
_NEVER = 1 << 60


def byte_signs() -> list[str]:
    """Printable sign of every byte: itself where it is visible, else the next free one from 256 on."""
    visible = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    free = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(free)) for b in range(256)]


class BpeModel:
    """Vocabulary, merges and text rules of a tokenizer file with word-end BPE over bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.ranks = {tuple(m): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.split_special = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern)
        self.signs = byte_signs()
        self.signs += [s + self.end for s in self.signs]
        self.longest = max(len(self.symbols_of_token(t)) for t in self.vocab)
        self.halves = {a + b: (a, b) for a, b in reversed(self.ranks)}
        self.forget()

    def forget(self) -> None:
        """Drop what has been worked out for pairs of tokens."""
        self._apart: dict[tuple, bool] = {}
        self._edges: dict[tuple, list] = {}

    def symbols_of_token(self, token: str) -> tuple[str, ...]:
        body = token[:-len(self.end)] if self.end and token.endswith(self.end) and token != self.end else token
        signs = list(body)
        if body != token:
            signs[-1] += self.end
        return tuple(signs)

    def edges(self, word: str) -> list[int]:
        """Numbers of the signs of a word: its bytes, the last one (with the word end) plus 256."""
        numbers = list(word.encode("utf-8"))
        numbers[-1] += 256
        return numbers

    def merged(self, parts: list[str]) -> list[str]:
        """Merges in rank order, leftmost first: the definition, used for single tokens only."""
        parts = list(parts)
        while True:
            best = min(((self.ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.ranks), default=None)
            if best is None:
                return parts
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def apart(self, left: str | None, right: str) -> bool:
        """Whether the two tokens next to each other are their own encoding: no merge across their border comes before the
        merges that use up the two signs beside it (on a tie the left pair comes first)."""
        key = (left, right)
        known = self._apart.get(key)
        if known is None:
            if len(self._apart) > MAX_PAIRS:
                self._apart.clear()
            if left is None:
                known = self.merged(list(self.symbols_of_token(right))) == [right]
            else:
                known = not any(
                    self.ranks.get((a, b), _NEVER) < min(a_used, b_used + 1)
                    for a, a_used in self._edge(left, 1) for b, b_used in self._edge(right, 0))
            self._apart[key] = known
        return known

    def _edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """Tokens that ever stand at the left (0) or right (1) edge while a token is built, and the rank that uses each up."""
        known = self._edges.get((token, side))
        if known is None:
            known, used, part = [], _NEVER, token
            while part is not None:
                known.append((part, used))
                halves = self.halves.get(part)
                part, used = (halves[side], self.ranks[halves]) if halves else (None, used)
            self._edges[token, side] = known
        return known

    def pieces(self, text: str):
        """Words and special tokens of a text, in order: (piece, is_special)."""
        for part in self.split_special.split(text) if self.special else [text]:
            if part in self.special:
                yield part, True
            elif part:
                plain = SPACE.sub(" ", unicodedata.normalize("NFC", part)).replace("Σ", "σ").lower()
                for word in self.words.findall(plain):
                    yield word, False


class PrefixTrie:
    """Trie of words with the last-token state of every node."""

    def __init__(self, model: BpeModel, max_nodes: int = MAX_NODES):
        self.model, self.max_nodes = model, max_nodes
        self.clear()

    def clear(self):
        self.children: dict[int, int] = {}              # node * 512 + number of the sign -> node
        self.parent, self.begin, self.symbol, self.token = array("i", [-1]), array("i", [-1]), [""], [None]
        self.known: dict[str, tuple] = {}

    def add(self, words: set[str]) -> None:
        """Insert words; sorted order makes the walk depth-first, each new node gets its state from its ancestors."""
        children, signs = self.children, self.model.signs
        for word in sorted(words):
            node = 0
            for number in self.model.edges(word):
                edge = node << 9 | number
                child = children.get(edge)
                if child is None:
                    child = len(self.parent)
                    children[edge] = child
                    self.parent.append(node)
                    self.symbol.append(signs[number])
                    token, begin = self._state(child)
                    self.token.append(token)
                    self.begin.append(begin)
                node = child
            ids = []
            while node:
                ids.append(self.model.vocab[self.token[node]])
                node = self.begin[node]
            ids.reverse()
            self.known[word] = (len(ids), " ".join(map(str, ids)), " ".join(self.model.strings[i] for i in ids))

    def _state(self, node: int) -> tuple[str, int]:
        vocab, model = self.model.vocab, self.model
        options, suffix, at = [], "", node
        for _ in range(model.longest):
            if not at:
                break
            suffix = self.symbol[at] + suffix
            at = self.parent[at]
            if suffix in vocab:
                options.append((suffix, at))
        for token, at in reversed(options):
            if model.apart(self.token[at], token):
                return token, at
        raise ValueError("sign without a token")

    def encode(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """(number of tokens, ids joined by a space, decoded text) of each text."""
        if len(self.parent) > self.max_nodes:
            self.clear()
        out = []
        for text in texts:
            pieces = list(self.model.pieces(text or ""))
            self.add({p for p, special in pieces if not special and p not in self.known})
            found = [(1, str(self.model.special[p]), p) if special else self.known[p] for p, special in pieces]
            out.append((sum(f[0] for f in found), " ".join([f[1] for f in found]), " ".join([f[2] for f in found])))
            if len(self.parent) > self.max_nodes:
                self.clear()
        return out


@lru_cache(maxsize=2)
def _model(path: str) -> BpeModel:
    """One model per worker process."""
    return BpeModel(path)


@contextmanager
def _trie(path: str):
    """The trie of one task. What it has learnt goes with the task: Spark keeps idle workers, and other stages run beside them."""
    trie = PrefixTrie(_model(path))
    try:
        yield trie
    finally:
        trie.clear()
        trie.model.forget()


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (joined by a space), decoded: a map over the rows, nothing is shuffled."""
    def run(batches):
        with _trie(path) as trie:
            for batch in batches:
                got = trie.encode(list(batch["text"]))
                yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": [g[0] for g in got],
                                    "ids": [g[1] for g in got], "decoded": [g[2] for g in got]})

    return docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(run, "doc_id string, n_tokens long, ids string, decoded string").withColumn(
        "doc_id", F.col("doc_id").cast("long"))


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and decoded text, taken where the text is encoded."""
    def run(batches):
        with _trie(path) as trie:
            for batch in batches:
                got = trie.encode(list(batch["text"]))
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"], "n_tokens": [g[0] for g in got],
                    "ids_sha256": [hashlib.sha256(g[1].encode()).hexdigest() for g in got],
                    "decoded_sha256": [hashlib.sha256(g[2].encode("utf-8")).hexdigest() for g in got]})

    return docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(
        run, "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumn(
        "doc_id", F.col("doc_id").cast("long"))
