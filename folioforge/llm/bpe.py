"""Byte-level BPE encoding and decoding with a deterministic tokenization automaton.

The merges are compiled one after another. At first a single state loops on every byte. A merge (u, v) looks at the
state q that the u-arcs enter: it adds a copy of q without its v-arc, sends the u-arcs there instead, and gives every
state with a u-arc an arc labelled uv that ends where q's v-arc ends. A sequence of tokens is accepted exactly if it
is what BPE makes of its bytes. Since all arcs with one label enter one state, that state is kept with the label; a
state is its parent and the one arc it lacks; whether an arc exists follows from both by descent (`lacks`) and is
tabulated when first asked for.

To encode, a text is split as byte-level BPE splits it and each word is run through the automaton along its arcs,
which spell the word in exactly one way. Words seen before come from a table of bounded size. To decode, arc labels
are emitted one after another.

Nulls and empty texts have no tokens. Long words are linear in their length.
"""

from __future__ import annotations

import json
from array import array as pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .shared import annotate, kept

#: The byte-level split, with Unicode's white space written out.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
#: Words kept in a task's table before it starts anew; longer words than this aren't kept.
KEPT_WORDS, KEPT_LENGTH = 400_000, 40
#: Arcs tabulated at most before the table starts anew; above every token id.
KEPT_ARCS, SHIFT = 500_000, 1 << 20


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file, as byte-level BPE defines it."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Tokenization automaton of a byte-level BPE vocabulary file."""

    def __init__(self, path: str, kept_words: int = KEPT_WORDS) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        vocab = {as_bytes(k): v for k, v in spec["model"]["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.label = {v: k for k, v in vocab.items()} | {v: k.encode() for k, v in self.special.items()}
        self.labels = [self.label.get(i, b"") for i in range(max(self.label) + 1)]
        self.longest = max(map(len, vocab))
        self.compile(vocab, [tuple(map(as_bytes, x.split(" ") if isinstance(x, str) else x)) for x in spec["model"]["merges"]])
        self.split = regex.compile(SPLIT)
        self.parts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words: dict[str, bytes] = {}
        self.kept_words, self.kept_arcs = kept_words, min(KEPT_ARCS, 2 * kept_words)

    def compile(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> None:
        """Successive merge gadgets. State 0 has an arc for every token; state m, made by merge m, is `parent[m]` less the arc `cut[m]`."""
        self.born = [0] * len(self.labels)  # the merge that made a token; bytes: 0
        self.left = [-1] * len(self.labels)
        self.enters = [-1] * len(self.labels)  # the state that a token's arcs enter
        self.ids = {t: i for t, i in vocab.items() if len(t) == 1}
        for i in self.ids.values():
            self.enters[i] = 0
        self.parent, self.cut = [0], [-1]
        self.arcs: dict[int, bool] = {}  # of state * SHIFT + token, as far as asked for: whether the arc is missing
        for m, (a, b) in enumerate(merges, 1):
            u, v, uv = self.ids.get(a), self.ids.get(b), vocab.get(a + b)
            self.parent.append(0)
            self.cut.append(-1)
            if u is None or v is None or uv is None or a + b in self.ids or self.lacks(self.enters[u], v):
                continue  # no accepted sequence has u before v: the merge never applies
            self.ids[a + b] = uv
            self.born[uv], self.left[uv], self.enters[uv] = m, u, self.enters[v]
            self.parent[m], self.cut[m] = self.enters[u], v
            self.enters[u] = m

    def lacks(self, state: int, token: int) -> bool:
        """Whether a state has no arc for a token. A token no older than the state has one where its left part has."""
        born, left, parent, cut = self.born, self.left, self.parent, self.cut
        while state:
            while born[token] >= state:
                token = left[token]
            if cut[state] == token:
                return True
            state = parent[state]
        return False

    def missing(self, key: int) -> bool:
        """Whether the arc `key` (state * SHIFT + token) is missing, from now on in the table."""
        if len(self.arcs) >= self.kept_arcs:
            self.arcs.clear()
        found = self.arcs[key] = self.lacks(*divmod(key, SHIFT))
        return found

    def word(self, word: bytes) -> list[int]:
        """Token ids of one pre-split word: the only accepted path, sought along the longest arcs first.

        A place in the word is reached by one accepted prefix only, so one from which no arc leads on is never tried again.
        """
        n, longest, token_at, arc, enters = len(word), self.longest, self.ids.get, self.arcs.get, self.enters
        path, starts, dead = [], [], None
        at, state, most = 0, 0, min(n, longest)
        while at < n:
            for to in range(most, at, -1):
                token = token_at(word[at:to])
                if token is None or dead is not None and to in dead:
                    continue
                if state:
                    none = arc(key := state * SHIFT + token)
                    if none or none is None and self.missing(key):
                        continue
                path.append(token)
                starts.append(at)
                at, state = to, enters[token]
                most = n if n - to <= longest else to + longest
                break
            else:
                dead = dead or set()
                dead.add(at)
                path.pop()
                most = at - 1
                at = starts.pop()
                state = enters[path[-1]] if path else 0
        return path

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        if self.parts is not None and any(x in text for x in self.special):
            return b"".join(np.array([self.special[x]], "<u4").tobytes() if x in self.special else self._plain(x) for x in self.parts.split(text) if x)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        words, pieces = self.words, self.split.findall(text)
        out = list(map(words.get, pieces))
        if None in out:
            if len(words) >= self.kept_words:
                words.clear()
            for i, piece in enumerate(pieces):
                if out[i] is None:
                    made = words.get(piece)
                    if made is None:
                        made = pack("I", self.word(piece.encode())).tobytes()
                        if len(piece) <= KEPT_LENGTH and len(words) < self.kept_words:
                            words[piece] = made
                    out[i] = made
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of little-endian ids; bytes that aren't UTF-8 become replacement characters."""
        labels = self.labels
        return b"".join([labels[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def automaton(path: str, kept_words: int = KEPT_WORDS) -> Automaton:
    """One for each Python worker, until it gets other work."""
    return kept(("bpe", path, kept_words), lambda: Automaton(path, kept_words))


def encode(docs: DataFrame, vocabulary: str, carry: list[str], text: str = "text", kept_words: int = KEPT_WORDS) -> DataFrame:
    """`carry`, ids (binary: little-endian unsigned 32-bit) and decoded (string), row by row without a shuffle.

    `kept_words`: words in a worker's table, about 250 bytes each; with fewer it is smaller and begins anew more often.
    """
    fields = [T.StructField("ids", T.BinaryType(), False), T.StructField("decoded", T.StringType(), False)]

    def make():
        auto = automaton(vocabulary, kept_words)

        def work(texts: pa.Array) -> list:
            ids = [auto.encode(x) for x in texts.to_pylist()]
            return [ids, [auto.decode(x) for x in ids]]

        return work

    return annotate(docs, text, carry, fields, make)
