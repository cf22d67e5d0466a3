"""Byte-pair encoding and decoding by a tokenization automaton.

The merges compile, in rank order, into a deterministic automaton over the tokens whose accepted
paths are exactly the correct tokenizations. It starts with one state and a self-loop for each
byte. The gadget of a merge (u, v) -> w

* gives what u leads to a private copy without its v arc (afterwards u is never followed by v);
* adds, wherever u still leaves a state, an arc w to the state that v led to (so of u u u the
  first two merge: where u = v, the private copy gets no arc w).

The transitions are a table, compiled gadget by gadget: a row for each state (what a token leads
to), a column for each arc. A gadget copies v's row for w, clears one entry of u's row, and copies
u's column for w. The table holds the first ``TABLE`` tokens, of which nearly all texts outside the
word caches consist. A full one would take a bit for each of 50,000 x 50,000 pairs in every worker,
so the states of later merges are persistent instead: a copy is a pointer to its origin with the
time of the copy, a removed arc an entry (state, arc) -> time, and an arc that a gadget added stands
at a state if the arc of its left part stood there at that time. Both forms give the same arcs.

Encoding runs the automaton over a pre-split word. Each prefix of a word has one correct
tokenization, so each place in it is reached in one state. Decoding emits the byte labels of the
arcs.

Pre-splitting follows the byte-level pattern of the vocabulary. Where no two white-space characters
meet, a text may be cut at line ends and before spaces, and what stands between is looked up in
bounded caches.

Defined cases: null text: empty; no ids for an empty text; the special token's string in a text is
that token, as in the tokenizers library's default; bytes that are not UTF-8 become U+FFFD.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemoor.llm.shared import map_arrow

#: Fixed value: the pre-splitting pattern of byte-level vocabularies of this family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Tokens whose transitions are compiled to a table of their square in bytes.
TABLE = 6144
#: Entries of a cache; it is emptied beyond.
CACHE = 250_000
#: Words up to so many bytes are cached.
CACHED_BYTES = 64


def byte_chars() -> dict[str, int]:
    """The printable stand-ins of bytes in such vocabularies: a byte that prints stands for itself, the others follow from U+0100."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Automaton:
    """The automaton of a list of merges; tokens are byte strings with ids."""

    def __init__(self, ids: dict[bytes, int], merges: list[tuple[bytes, bytes]], table: int = TABLE) -> None:
        n = max(ids.values()) + 1
        self.ids = ids
        self.left, self.right = [-1] * n, [-1] * n
        #: When the arcs of a token came to be; bytes have been there from the start.
        self.born = [-1] * n
        #: (token whose private state lost the arc, arc) -> when.
        self.cut: dict[tuple[int, int], int] = {}
        for time, (a, b) in enumerate(merges):  # a gadget takes two ticks: it cuts at the first and adds at the second
            time *= 2
            u, v, w = ids[a], ids[b], ids[a + b]
            self.cut[u, v] = time
            if self.born[w] < 0 and len(a) + len(b) > 1:
                self.left[w], self.right[w], self.born[w] = u, v, time
        #: The labels of the arcs, by their bytes: (node, byte) -> node, and the arc whose label ends at a node.
        self.step: dict[int, int] = {}
        self.ends = [-1]
        for token, i in ids.items():
            node = 0
            for byte in token:
                to = self.step.get(node << 8 | byte)
                if to is None:
                    to = self.step[node << 8 | byte] = len(self.ends)
                    self.ends.append(-1)
                node = to
            self.ends[node] = i
        self.known: dict[tuple[int, int], bool] = {}
        self._compile(merges, table)

    def _compile(self, merges: list[tuple[bytes, bytes]], size: int) -> None:
        """The table of the first tokens: ``place`` of each token in it, and whether the arc of a column leaves the state of a row."""
        ids = self.ids
        order = [i for token, i in ids.items() if self.left[i] < 0]
        order += [ids[a + b] for time, (a, b) in enumerate(merges) if self.born[ids[a + b]] == 2 * time]
        self.size = size = min(size, len(order))
        self.place = [size] * len(self.left)
        for k, i in enumerate(order[:size]):
            self.place[i] = k
        place = self.place
        arcs = np.zeros((size, size), dtype=bool)
        bytes_ = sum(self.left[i] < 0 for i in order[:size])
        arcs[:bytes_, :bytes_] = True
        for time, (a, b) in enumerate(merges):
            u, v, w = place[ids[a]], place[ids[b]], ids[a + b]
            k = place[w] if self.born[w] == 2 * time else size
            if max(u, v) >= size:
                continue
            if k < size:
                arcs[k] = arcs[v]
            arcs[u, v] = False
            if k < size:
                arcs[:, k] = arcs[:, u]
        self.arcs = arcs.tobytes()

    def _stands(self, u: int, t: int, until: int) -> bool:
        """Whether the state behind u had the arc t just before the gadget of time ``until``."""
        while True:
            state, time = u, until
            while state >= 0:  # the private copy, then the states that it was copied from
                if self.cut.get((state, t), time) < time:
                    return False
                time = min(time, self.born[state])
                state = self.right[state]
            if self.left[t] < 0:
                return True
            until = min(until, self.born[t] + (self.left[t] == self.right[t]))
            t = self.left[t]

    def goes(self, u: int, t: int) -> bool:
        """Whether an arc t leaves the state behind u."""
        row, column, size = self.place[u], self.place[t], self.size
        if row < size and column < size:
            return self.arcs[row * size + column] == 1
        pair = (u, t)
        found = self.known.get(pair)
        if found is None:
            if len(self.known) > CACHE:
                self.known.clear()
            found = self.known[pair] = self._stands(u, t, 1 << 60)
        return found

    def encode(self, word: bytes) -> list[int]:
        """Ids of one pre-split word, by running the table with the longest arcs first.

        A place is reached by one path only, so a place from which the word's end cannot be
        reached is closed for good, and the work is at most length times longest token.
        """
        ids, n = self.ids, len(word)
        t = ids.get(word)
        if t is not None and self._whole(t):
            return [t]
        goes, step, ends = self.goes, self.step.get, self.ends
        place, size, table = self.place, self.size, self.arcs
        path: list[int] = []
        places = [0]
        closed = bytearray(n + 1)
        while True:
            at = places[-1]
            if at == n:
                return path
            node, arcs = 0, []
            for to in range(at, n):
                node = step(node << 8 | word[to])
                if node is None:
                    break
                if ends[node] >= 0 and not closed[to + 1]:
                    arcs.append((to + 1, ends[node]))
            row = place[path[-1]] if path else -1
            for to, t in reversed(arcs):
                if (self._whole(t) if row < 0 else table[row * size + place[t]] if row < size > place[t] else goes(path[-1], t)):
                    path.append(t)
                    places.append(to)
                    break
            else:
                closed[at] = 1
                if not path:
                    raise ValueError(f"the vocabulary lacks a byte of {word!r}")
                path.pop()
                places.pop()

    def _whole(self, t: int) -> bool:
        """Whether the start state has the arc t: each token of the merges tokenizes itself, if its parts come to meet."""
        pair = (-1, t)
        found = self.known.get(pair)
        if found is None:
            u, v, time = self.left[t], self.right[t], self.born[t]
            found = self.known[pair] = u < 0 or (self._whole(u) and self._stands(u, v, time))
        return found


class _Words(dict):
    """Ids, as little-endian bytes, of words; encode: bytes of a word -> ids."""

    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        raw = word.encode()
        ids = b"".join([t.to_bytes(4, "little") for t in self.encode(raw)])
        if len(raw) <= CACHED_BYTES:
            if len(self) > CACHE:
                self.clear()
            self[word] = ids
        return ids


class _Chunks(dict):
    """Ids, as little-endian bytes, of what stands between two cuts; before: the space there, or nothing."""

    def __init__(self, before: str, split, words: _Words) -> None:
        self.before, self.split, self.words = before, split, words

    def __missing__(self, chunk: str) -> bytes:
        words = self.words
        ids = b"".join([words[w] for w in self.split(self.before + chunk)])
        if len(chunk) <= CACHED_BYTES:
            if len(self) > CACHE:
                self.clear()
            self[chunk] = ids
        return ids


class Tokenizer:
    """Encode and decode with a vocabulary file of the tokenizers library (byte-level BPE).

    engine: "automaton", or "tiktoken" for that library's merge loop on single words, which gives
    the same ids sooner (the packing operator counts tokens with it).
    """

    def __init__(self, path: str, engine: str = "automaton") -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_chars()
        raw = lambda s: bytes(chars[c] for c in s)
        ids = {raw(s): i for s, i in spec["model"]["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.automaton = Automaton(ids, [(raw(a), raw(b)) for a, b in merges]) if engine == "automaton" else None
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in ids.items():
            self.labels[i] = token
        for s, i in self.special.items():
            self.labels[i] = s.encode()
        self.at_special = re.compile("|".join(map(re.escape, self.special)) or "(?!)")
        split = regex.compile(PATTERN).findall
        self.split = split
        encode = self.automaton.encode if engine == "automaton" else _merge_loop(ids)
        self.words = _Words(encode)
        self.first, self.spaced = _Chunks("", split, self.words), _Chunks(" ", split, self.words)
        self.run_of_space = re.compile(r"\s\s").search
        self.line_end = self.words["\n"]

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.at_special.search(text):
            out, at = [], 0
            for m in self.at_special.finditer(text):
                out += [self._plain(text[at : m.start()]), self.special[m[0]].to_bytes(4, "little")]
                at = m.end()
            return b"".join([*out, self._plain(text[at:])])
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if self.run_of_space(text):
            words = self.words
            return b"".join([words[w] for w in self.split(text)])
        out, spaced = [], self.spaced
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append(self.line_end)
            if line:
                first, *rest = line.split(" ")
                if first:
                    out.append(self.first[first])
                out += [spaced[c] for c in rest]
        return b"".join(out)

    def decode_bytes(self, ids: bytes) -> str:
        labels = self.labels
        return b"".join([labels[i] for i in memoryview(ids).cast("I")]).decode("utf-8", "replace")


def _merge_loop(ids: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ids, special_tokens={})._encode_single_piece


@lru_cache(maxsize=2)
def tokenizer(path: str, engine: str = "automaton") -> Tokenizer:
    return Tokenizer(path, engine)


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def texts_of(column: pa.Array) -> list[str]:
    return [b.decode("utf-8", "replace") if b else "" for b in column.to_pylist()]


def bpe_encode(df: DataFrame, name: str = "byte_bpe_50k.json", id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """Per row: id, ids (binary, little-endian unsigned 32-bit integers) and, if asked for, ``decoded``: the text that the ids decode to."""

    def run(batches):
        t = tokenizer(vocabulary(name))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [t.encode_bytes(x) for x in texts_of(part.column("text"))]
                cols = [part.column("id"), pa.array(ids, pa.large_binary() if sum(map(len, ids)) >> 30 else pa.binary())]
                if decode:
                    cols.append(pa.array([t.decode_bytes(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=["id", "ids", "decoded"][: len(cols)])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    out = map_arrow(rows, run, "id long, ids binary" + ", decoded string" * decode)
    return out.withColumnRenamed("id", id_col)


def bpe_decode(df: DataFrame, name: str = "byte_bpe_50k.json", id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and ``decoded``, the text of the ids (binary, as :func:`bpe_encode` gives them; null: empty)."""

    def run(batches):
        t = tokenizer(vocabulary(name))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([t.decode_bytes(x or b"") for x in batch.column("ids").to_pylist()], pa.string())], names=["id", "decoded"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    return map_arrow(rows, run, "id long, decoded string").withColumnRenamed("id", id_col)
