"""Quality rules: learned decision lists.

``statistics`` measures every whole text. ``learn`` grows an ordered list
of threshold conjunctions that name bad documents, by sequential covering
on labelled statistics: each rule is grown condition by condition for the
largest information gain on two thirds of the rows still uncovered, pruned
from its end on the other third, and kept while it stays precise there.
``verdict`` turns the list into one ordered Spark conditional expression.

Learning takes at most ``SAMPLE_ROWS`` labelled rows (those first by a
hash of their id), a table of numbers only; everything else covers all rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import map_texts

SAMPLE_ROWS = 20_000    # most labelled rows that a list is learned from
MAX_RULES = 12
MAX_CONDITIONS = 4
THRESHOLDS = 64         # candidate thresholds for each statistic
MIN_PRECISION = 0.95    # on the pruning rows, else learning ends
GOOD_WEIGHT = 10        # a good row lost counts as so many bad rows kept
MIN_COVER = 3           # fewest bad rows that a rule must name there

WINDOW = 8              # words of a repeated window
MIN_WORDS = 20          # base rule
REPEAT_SHARE = (30, 100)

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_MARKS = "!?|*#$%&<>=+~^"

BASE_FIELDS = [("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"),
               ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint")]
#: What rules may test, beside n_words: shares that don't drift with length.
#: twin_share: words equal to the word before.
RATIOS = ["mean_word_chars", "symbol_share", "dup_line_share", "repeat_share", "upper_share",
          "mark_share", "digit_share", "twin_share", "top_word_share"]
FEATURES = ["n_words"] + RATIOS


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words (a power of two) found
    at least twice. Windows are compared exactly: the ranks of windows of
    one length, in pairs, rank the windows of twice that length."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict = {}
    rank = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    if len(ids) == len(words):
        return 0
    step = 1
    while step < window:
        pair = rank[:-step] * len(words) + rank[step:]
        _, rank = np.unique(pair, return_inverse=True)
        step *= 2
    seen = np.bincount(rank)
    hits = np.flatnonzero(seen[rank] > 1)
    if not len(hits):
        return 0
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, hits, 1)
    np.add.at(edge, hits + window, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def measure(text: str | None) -> tuple:
    """The base statistics, then ``RATIOS``, of one text (null: none)."""
    t = text or ""
    words = t.encode().split()           # on ASCII white space only
    n = len(words)
    spaces = sum(map(t.count, _SPACE))
    word_chars = len(t) - spaces
    n_symbols = sum(map(t.count, _SYMBOLS))
    lines = [x for x in t.split("\n") if x.strip(_SPACE)]
    n_dup = len(lines) - len(set(lines))
    n_repeat = repeated_words(words)
    if not n:
        return (0, 0, n_symbols, 0, 0) + (0.0,) * len(RATIOS)
    counts = Counter(words)
    raw = np.frombuffer(t.encode(), dtype=np.uint8)
    hist = np.bincount(raw, minlength=256)
    upper = int(hist[65:91].sum())
    letters = upper + int(hist[97:123].sum())
    marks = int(hist[[ord(c) for c in _MARKS]].sum())
    return (n, word_chars, n_symbols, n_dup, n_repeat,
            word_chars / n, n_symbols / n, n_dup / len(lines), n_repeat / n,
            upper / max(letters, 1), marks / n, int(hist[48:58].sum()) / word_chars,
            sum(map(eq, words, words[1:])) / n, max(counts.values()) / n)


def statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep``, then the statistics of every whole text. A null or
    empty text has zeros; repeated rows are measured each."""
    def make():
        return lambda texts: list(map(list, zip(*map(measure, texts)))) or \
            [[] for _ in range(len(BASE_FIELDS) + len(RATIOS))]
    return map_texts(docs, text, ["doc_id"] if keep is None else keep,
                     BASE_FIELDS + [(r, "double") for r in RATIOS], make)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool        # feature >= threshold, else feature < threshold
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        v = values[self.feature]
        return v >= self.threshold if self.above else v < self.threshold

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= F.lit(self.threshold) if self.above else c < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:g}"


def _cover(rule, values, n):
    on = np.ones(n, dtype=bool)
    for c in rule:
        on &= c.holds(values)
    return on


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else 0.0


def _best_condition(values, bad, on, cuts):
    """The condition of the largest gain over the rows ``on``."""
    p0, n0 = int((bad & on).sum()), int((~bad & on).sum())
    best, gain = None, 1e-9
    for f, edges in cuts.items():
        if not len(edges):
            continue
        slot = np.searchsorted(edges, values[f][on], side="right")   # edges[:slot] <= value
        p = np.bincount(slot[bad[on]], minlength=len(edges) + 1)
        n = np.bincount(slot[~bad[on]], minlength=len(edges) + 1)
        below_p, below_n = np.cumsum(p), np.cumsum(n)
        for i, e in enumerate(edges):
            for above in (True, False):
                a, b = ((p0 - below_p[i], n0 - below_n[i]) if above else (below_p[i], below_n[i]))
                g = _gain(int(a), GOOD_WEIGHT * int(b), p0, GOOD_WEIGHT * n0)
                if g > gain:
                    best, gain = Condition(f, above, float(e)), g
    return best


def learn(values: dict[str, np.ndarray], bad: np.ndarray) -> list[list[Condition]]:
    """Ordered rules that name bad rows; none if the rows show none."""
    n = len(bad)
    rules: list[list[Condition]] = []
    if not n or not bad.any() or bad.all():
        return rules
    third = np.arange(n) % 3 == 0                       # the pruning rows
    left = np.ones(n, dtype=bool)
    cuts = {}
    for f, v in values.items():
        u = np.unique(np.quantile(v, np.linspace(0, 1, THRESHOLDS + 1)))
        tail = np.unique(np.quantile(v[bad], np.linspace(0, 1, THRESHOLDS + 1)))
        cuts[f] = np.unique(np.round(np.concatenate([u, tail]), 6))
    while len(rules) < MAX_RULES and (bad & left & ~third).any():
        rule: list[Condition] = []
        on = left & ~third
        while len(rule) < MAX_CONDITIONS and (~bad & on).any():
            c = _best_condition(values, bad, on, cuts)
            if c is None:
                break
            rule.append(c)
            on &= c.holds(values)
        if not rule:
            break

        def worth(r):
            on = left & third & _cover(r, values, n)
            p, q = int((bad & on).sum()), int((~bad & on).sum())
            return (p - GOOD_WEIGHT * q) / (p + q) if p + q else -1.0, p, q

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=lambda r: worth(r)[0])
        _, p, q = worth(rule)
        if p < MIN_COVER or p < MIN_PRECISION * (p + q):
            break
        rules.append(rule)
        left &= ~_cover(rule, values, n)
    return rules


def learn_from(stats: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[list[Condition]]:
    """Learn from statistics joined with ``labels`` (doc_id, y: 1 good)."""
    sample = (stats.select("doc_id", *FEATURES).join(labels, "doc_id")
              .orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).limit(rows).toPandas())
    values = {f: sample[f].to_numpy(dtype=float) for f in FEATURES}
    return learn(values, (sample["y"] == 0).to_numpy())


def verdict(rules: list[list[Condition]]) -> Column:
    """The number (from 1) of the first rule that names the row, else null."""
    out = None
    for k, rule in enumerate(rules, 1):
        cond = rule[0].column()
        for c in rule[1:]:
            cond &= c.column()
        out = F.when(cond, F.lit(k)) if out is None else out.when(cond, F.lit(k))
    return F.lit(None).cast("int") if out is None else out.otherwise(F.lit(None).cast("int"))


def base_failed() -> Column:
    part, whole = REPEAT_SHARE
    return (F.col("n_words") < MIN_WORDS) | (whole * F.col("n_repeat_words") > part * F.col("n_words"))
