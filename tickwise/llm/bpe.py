"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens: its state is the token read last and its arcs
are the tokens that may follow, so that its paths are exactly the
encodings that the merges give. It is compiled by one gadget a merge, in
order. The gadget of (a, b) makes a token c: wherever a may stand and b may
follow it, c may stand instead (c gets a's column of arcs); what may follow
c is what may follow b (b's row); and the arc from a to b is removed. Where
a is b, runs merge from the left: a itself gets no arc to c.

As a row or column is copied whole and loses one arc a merge, the table is
kept as the log of its gadgets (for each token its two parts and its
merge, for each removed arc the merge that removed it); an arc is read off
that log in a few steps and remembered by the task. Texts come by letter: a
second table, the goto and output tables over the labels of the arcs (Aho and
Corasick's), reads a word letter by letter and gives at each the labels that end
there. Every beginning of a word has one path, so exactly one of these has an
arc from the path's token at its start; it is noted, and at the last letter the
path is read off the notes. One pass, no step back. Decoding emits the labels
of the arcs.

The vocabulary file is read by the driver; the compiled log (some MB, its
size set by the vocabulary) is broadcast. Texts are split, encoded and
decoded where they are. Normalisation and splitting are those of one kind of
file (canonical composition, lower case, words, digits and marks apart,
letters for bytes); a file that asks for others is refused.
"""

from __future__ import annotations

import json
import re
import unicodedata
from dataclasses import dataclass

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from tickwise.llm.common import map_texts

WORD_CACHE = 300_000      # words whose codes a task remembers (some 60 MB); then it starts anew
ARC_CACHE = 400_000       # arcs that a task remembers
CACHED_CHARS = 64         # longer words are encoded each time

# White space of the splitting pattern, and its clitics.
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CLITICS = "'s|'t|'re|'ve|'m|'ll|'d"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"     # as the files state it
WORD = regex.compile(rf"{CLITICS}|\p{{L}}+|\p{{N}}|[^{WHITE_SPACE}\p{{L}}\p{{N}}]+")


_LAST = "\ue000"          # stands behind a word's last letter; no byte's letter
_ASCII_WORD = re.compile(rf"{CLITICS}|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")     # the same of lower-case ASCII


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself,
    the others for the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (c for c in range(256) if c not in plain)
    other = {b: 256 + i for i, b in enumerate(rest)}
    return [chr(other.get(b, b)) for b in range(256)]


@dataclass(frozen=True)
class Automaton:
    labels: list[str]               # of the arcs, by token id
    first: np.ndarray               # the two parts of a merged token
    second: np.ndarray
    merge: np.ndarray               # the merge that made it, -1 for letters
    removed: dict[int, int]         # arc (from << 32 | to) -> the merge that removed it
    dead: frozenset[int]            # merged tokens that no gadget made
    end: str                        # suffix of a word's last letter
    special: list[tuple[str, int]]  # strings that are tokens as they stand


def arc(first, second, merge, removed, u: int, v: int, before: int) -> bool:
    """Whether token ``v`` may follow token ``u`` once the merges below
    ``before`` have had their gadgets."""
    while True:
        cut = removed.get(u << 32 | v)
        if cut is not None and cut < before:
            return False
        mu, mv = merge[u], merge[v]
        if mu < 0 and mv < 0:
            return True
        if mu > mv:
            u, before = second[u], mu        # u's row was copied just before its merge
        else:
            v, before = first[v], mv + 1     # v's column was copied with its merge


def _settings(spec: dict) -> dict:
    """What a vocabulary file asks for beside its tokens and merges."""
    model = {k: v for k, v in spec["model"].items() if k not in ("vocab", "merges", "end_of_word_suffix") and v}
    added = [k for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized") if t.get(k)]
    return {"normalizer": spec.get("normalizer"), "pre_tokenizer": spec.get("pre_tokenizer"),
            "post_processor": spec.get("post_processor"), "decoder": spec.get("decoder"), "model": model, "added": added}


#: The settings that ``Coder`` follows (fixed values of the file format).
SETTINGS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None, "decoder": None, "model": {"type": "BPE"}, "added": []}


def compile_merges(path: str) -> Automaton:
    """Read a BPE vocabulary file (JSON) and compile its merges. A file whose
    other settings are not those that texts are coded by is an error."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    asked = _settings(spec)
    other = [k for k in SETTINGS if asked[k] != SETTINGS[k]]
    if other:
        raise ValueError(f"this file asks for another {', '.join(other)}: {[asked[k] for k in other]}")
    model = spec["model"]
    vocab: dict[str, int] = model["vocab"]
    special = sorted(((t["content"], t["id"]) for t in spec.get("added_tokens", [])),
                     key=lambda t: (-len(t[0]), t[0]))
    size = 1 + max([*vocab.values(), *(i for _, i in special)])
    labels = [""] * size
    for label, i in [*vocab.items(), *special]:
        labels[i] = label
    first, second, merge = ([-1] * size for _ in range(3))
    removed: dict[int, int] = {}
    dead = set()
    for k, pair in enumerate(model["merges"]):
        a, b = (vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
        c = vocab[labels[a] + labels[b]]
        first[c], second[c], merge[c] = a, b, k
        if a in dead or b in dead or not arc(first, second, merge, removed, a, b, k):
            dead.add(c)
        else:
            removed[a << 32 | b] = k
    ints = [np.array(x, dtype=np.int32) for x in (first, second, merge)]
    return Automaton(labels, *ints, removed, frozenset(dead), model.get("end_of_word_suffix") or "", special)


class Coder:
    """A task's tables: token ids by label, remembered arcs and words."""

    def __init__(self, automaton: Automaton):
        a = automaton
        self.labels, self.end, self.removed = a.labels, a.end, a.removed
        self.first, self.second, self.merge = a.first.tolist(), a.second.tolist(), a.merge.tolist()
        self.special = dict(a.special)
        self.split = regex.compile("|".join(regex.escape(t) for t, _ in a.special)) if a.special else None
        self.letters = byte_letters()
        self.inner, self.final = {}, {}
        for i, label in enumerate(a.labels):
            if label and i not in a.dead and label not in self.special:
                last = label.endswith(a.end) and len(label) > len(a.end)
                if a.end and last:
                    self.final[label[:-len(a.end)]] = i
                else:
                    self.inner[label] = i
        if not a.end:
            self.final = self.inner
        self.goto = ahocorasick.Automaton()
        for label, i in self.inner.items():
            self.goto.add_word(label, (i, len(label)))
        for label, i in self.final.items():
            self.goto.add_word(label + _LAST, (i, len(label) + 1))
        self.goto.make_automaton()
        self.arcs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}

    def follows(self, u: int, v: int) -> bool:
        key = u << 32 | v
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= ARC_CACHE:
                self.arcs.clear()
            known = self.arcs[key] = arc(self.first, self.second, self.merge, self.removed, u, v, 1 << 62)
        return known

    def walk(self, word: str) -> list[int]:
        """The tokens of one word (in byte letters). ``at[i]`` notes the last
        token, and its start, of the path through the first i letters."""
        at: list = [None] * (len(word) + 2)
        arcs = self.arcs.get
        for end, (t, size) in self.goto.iter(word + _LAST):
            if at[end + 1] is None:
                start = end + 1 - size
                if start:
                    before = at[start]
                    if before is None:
                        continue
                    known = arcs(before[0] << 32 | t)
                    if not (self.follows(before[0], t) if known is None else known):
                        continue
                at[end + 1] = t, start
        path, here = [], len(word) + 1
        while here:
            if at[here] is None:
                raise ValueError(f"no path for {word!r}")
            t, here = at[here]
            path.append(t)
        return path[::-1]

    def word_codes(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            letters = self.letters
            path = self.walk("".join([letters[b] for b in word.encode()]))
            got = np.array(path, dtype="<u4").tobytes()
            if len(word) <= CACHED_CHARS:
                if len(self.words) >= WORD_CACHE:
                    self.words.clear()
                self.words[word] = got
        return got

    def _plain(self, text: str) -> bytes:
        get, new = self.words.get, self.word_codes
        if text.isascii():
            return b"".join([get(w) or new(w) for w in _ASCII_WORD.findall(text.lower())])
        # one character at a time: no final form of sigma
        low = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return b"".join([get(w) or new(w) for w in WORD.findall(low)])

    def encode(self, text: str | None) -> bytes:
        """Token ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.split is None or not any(t in text for t in self.special):
            return self._plain(text)
        out, at = [], 0
        for m in self.split.finditer(text):
            out.append(self._plain(text[at:m.start()]))
            out.append(np.array([self.special[m[0]]], dtype="<u4").tobytes())
            at = m.end()
        out.append(self._plain(text[at:]))
        return b"".join(out)

    def decode(self, codes: bytes | None) -> str:
        """The labels of the ids, a space between two."""
        labels = self.labels
        return " ".join([labels[i] for i in np.frombuffer(codes or b"", dtype="<u4").tolist()])


def _mapped(df: DataFrame, automaton: Automaton, col: str, keep, fields, row, binary=False) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(automaton)

    def make():
        # The task's own: a worker outlives the stage, and its tables would
        # stand beside all that the executor does next (built in 0.1 s).
        coder = Coder(shared.value)
        return lambda values: [list(c) for c in zip(*[row(coder, v) for v in values])] or [[] for _ in fields]

    return map_texts(df, col, keep, fields, make, binary)


def encode(docs: DataFrame, automaton: Automaton, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep``, then ids (binary: little-endian unsigned 32-bit
    integers). Null and empty texts have no ids; repeated rows are encoded
    each; further columns are ignored."""
    return _mapped(docs, automaton, text, ["doc_id"] if keep is None else keep, [("ids", "binary")],
                   lambda c, t: (c.encode(t),))


def round_trip(docs: DataFrame, automaton: Automaton, text: str = "text",
               keep: list[str] | None = None) -> DataFrame:
    """As ``encode``, and the text that the ids decode to as ``decoded``."""
    def row(coder, t):
        ids = coder.encode(t)
        return ids, coder.decode(ids)
    return _mapped(docs, automaton, text, ["doc_id"] if keep is None else keep,
                   [("ids", "binary"), ("decoded", "string")], row)
