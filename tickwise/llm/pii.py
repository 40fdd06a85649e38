"""Personal data by weak supervision, in DataFrame operations only.

Base spans are what four patterns and their rules accept. Proposals are
spans that the patterns lose: a number swallowed by a run of digits beside
it, a national or spelled-out form. Base spans and proposals alike are put
to six labelers (one of form, one of arithmetic, one gazetteer, three of
context), each of which says yes, no or nothing. Votes are counted by
pattern in Spark; expectation-maximisation over these counts estimates how
reliable each labeler is and, with that, how likely each pattern is personal
data. A logistic classifier of span features is fitted to these likelihoods,
again from counts by feature pattern, and decides the proposals. Base spans
stay whatever it says.

Matches are found with their places by splitting a text at them: the pieces
between give the places by a running sum, and the context of each match.

Cases: a null text is an empty one and has no spans; nulls and repeats in
other columns, and columns named like inner ones, stay as they are. All work
on a text is linear in its length, repeated groups of the patterns are
possessive (no recursion on long runs). Ties: a proposal whose likelihood is
exactly one half is taken. Without any candidate the classifier takes none;
an empty table gives no row. Training reads every candidate of all rows; the
driver gets at most 3^6 vote patterns and 2^11 feature patterns a kind.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.session import stored

KINDS = ("email", "ip", "card", "phone")
LEFT, RIGHT = 24, 12     # code points of context
BLOCK = 64               # elements taken together for running values
PLACE = 1 << 40          # places of one kind, in a number that orders by kind and place
LABELERS = ("format", "rule", "gazetteer", "left_context", "boundary", "right_context")
FEATURES = ("rule", "format", "gazetteer", "left_clean", "right_clean", "left_yes", "left_no", "right_no",
            "separated", "digits_before", "digits_after")
#: A labeler's reliability before any vote is seen (others: 0.7), which counts as
#: much as all the votes it can give: arithmetic is trusted more than a list.
PRIOR = {"rule": 0.95, "boundary": 0.9, "format": 0.8}
ROUNDS, THRESHOLD, RIDGE = 100, 0.5, 1e-3

#: Country-code top-level domains and generic ones, issuer
#: prefixes, calling codes that the gazetteer labelers know.
TOP_LEVEL = "com org net edu gov mil int info biz io dev app de fr es it nl be at ch uk us ca mx br ar au nz jp kr cn in"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|36|6011|65|35)"
CALLING = r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|35[1-9]|38[0-9]|42[013]|9[67][0-9])"


@dataclass(frozen=True)
class Kind:
    """One kind of personal data: the base pattern and rule; a cheap test that
    each pattern needs to hold first; the proposals' pattern; and what its
    labelers look for in a span and around it."""
    name: str
    base: str
    needs: str
    propose: str
    propose_needs: str
    canonical: str
    left_yes: str
    left_no: str
    right_no: str
    rule: Callable[[Column], Column] = field(repr=False)
    base_rule: Callable[[Column], Column] = field(repr=False)
    gazetteer: Callable[[Column], Column] = field(repr=False)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), body)[0]


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The check digit holds, of at most 19 digits."""
    def valid(padded: Column) -> Column:
        total = F.lit(0)
        for i in range(1, 20):
            digit = F.substring(padded, i, 1)
            total = total + (digit if i % 2 else F.translate(digit, "0123456789", "0246813579")).cast("int")
        return total % 10 == 0
    return let(F.lpad(digits, 19, "0"), valid)


def _card(low: int) -> Callable[[Column], Column]:
    return lambda s: let(_digits(s), lambda d: F.when(F.length(d).between(low, 19), luhn(d)).otherwise(False))


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_LOCAL = "[A-Za-z0-9._%+-]"
_RUN = f"(?:\\G|(?<!{_LOCAL})){_LOCAL}++"   # a whole run, or what the last match left of it
_AT, _DOT = r"(?i:\[at\]|\(at\)|\{at\})", r"(?i:\[dot\]|\(dot\)|\{dot\}|\.)"


def _quad(span: Column) -> Column:
    return span.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")


KIND = {
    "email": Kind(
        "email", rf"{_RUN}@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
        rf"{_RUN} ?{_AT} ?[A-Za-z0-9-]++(?: ?{_DOT} ?[A-Za-z0-9-]++)++", r"(?i)[\[({]at[\])}]",
        r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$",
        r"(?i)\b(?:e-?mail|mail|contact|write|reply|correo|courriel|kontakt)\b", r"(?i)\b(?:version|ssh|git)\b",
        r"^[:/]", lambda s: ~s.rlike(r"^[.-]|\.\.|[0-9.-]$"), lambda s: F.lit(True),
        lambda s: F.lower(F.regexp_extract(s, "([A-Za-z]+)$", 1)).isin(TOP_LEVEL.split())),
    "ip": Kind(
        "ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]",
        r"(?<![0-9A-Za-z:.])(?:(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])|(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:]))",
        r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]",
        r"^(?:[1-9]?[0-9]{1,2}(?:\.(?:0|[1-9][0-9]{0,2})){3}|(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4})$",
        r"(?i)\b(?:ip|host|server|addr|address|login|from|client)\b", r"(?i)\b(?:version|v|release|section|chapter)\b",
        r"^\.[0-9]", lambda s: _quad(s) | s.rlike("^[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}$"), _quad,
        lambda s: ~s.rlike(r"^(?:0|127|255)\.")),
    "card": Kind(
        "card", r"[0-9](?:[ -]?[0-9])++", r"[0-9]",
        r"(?<![0-9A-Za-z])(?:[0-9]{16,19}|3[47][0-9]{13}|3(?:0[0-5]|[68][0-9])[0-9]{11}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9A-Za-z])",
        r"[0-9]{4}(?:[0-9]{10}|[ -][0-9]{4})",
        r"^(?:[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[0-9]{3}([ -])[0-9]{6}\2[0-9]{5})$",
        r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|tarjeta|carte)\b",
        r"(?i)\b(?:isbn|order|invoice|token|serial|sku|tracking|key|hash|password)\b", r"^(?:\.[0-9]|%)",
        _card(14), _card(16), lambda s: s.rlike(ISSUERS)),
    "phone": Kind(
        "phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]",
        r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})[ .-]?[0-9]{2,4}[ .-][0-9]{3,4}(?![0-9])|\+[0-9]{8,15}(?![0-9])"
        r"|(?<![0-9+.-] ?)(?:\([0-9]{3}\) ?[0-9]{3}[-.][0-9]{4}|[0-9]{3}([-.])[0-9]{3}\1[0-9]{4})(?![0-9]|[.-][0-9])",
        r"\+[0-9]|[0-9]{3}[-.][0-9]{4}", r"^(?:\+[0-9]{1,3} ?)?\([0-9]{3}\) ?[0-9]{3}[-.][0-9]{4}$|^\+[0-9]{8,15}$",
        r"(?i)\b(?:phone|tel|call|mobile|fax|cell|whatsapp|telefon|llame|appel)\b",
        r"(?i)\b(?:isbn|order|version|invoice|token|key)\b", r"^(?:[A-Za-z]|%)",
        lambda s: F.length(_digits(s)).between(8, 15), lambda s: F.length(_digits(s)).between(8, 15),
        lambda s: s.rlike(CALLING) | s.rlike(r"^\(?[2-9][0-9]{2}\)?")),
}


# ---- matches with their places -----------------------------------------------

def prefixes(xs: Column, zero: Column, op: Callable[[Column, Column], Column]) -> Column:
    """``zero``, then what the associative ``op`` makes of the elements up to
    each (one value more than ``xs`` has). Blocks of BLOCK elements are taken
    together first: an array in an aggregate's buffer would be copied at each
    of its steps."""
    def over(part: Column) -> Column:
        return F.aggregate(part, zero, lambda v, x: op(v, x))

    def of(xs: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), (F.size(xs) / BLOCK).cast("int")),
                             lambda b: over(F.slice(xs, b * BLOCK + 1, F.lit(BLOCK))))
        before = let(blocks, lambda bs: F.transform(bs, lambda _, i: over(F.slice(bs, F.lit(1), i))))
        return let(before, lambda ps: F.transform(
            F.sequence(F.lit(0), F.size(xs)),
            lambda i: op(ps[(i / BLOCK).cast("int")], over(F.slice(xs, i - i % BLOCK + 1, i % BLOCK)))))

    return let(xs, of)


MATCH = "array<struct<start:bigint,end:bigint,span:string,left:string,right:string>>"


def matches(text: Column, pattern: str, needs: str, rule: Callable[[Column], Column]) -> Column:
    """The leftmost non-overlapping matches that ``rule`` accepts, with their
    places in code points (end exclusive) and the text before and after, as
    far as the next match goes."""
    def placed(m: Column) -> Column:
        lengths = F.transform(m["found"], lambda x, i: (F.length(m["gaps"][i]) + F.length(x)).cast("bigint"))
        ends = prefixes(lengths, F.lit(0).cast("bigint"), lambda v, x: v + x)
        spans = let(ends, lambda e: F.transform(m["found"], lambda x, i: F.struct(
            (e[i + 1] - F.length(x)).alias("start"), e[i + 1].alias("end"), x.alias("span"),
            F.right(m["gaps"][i], F.lit(LEFT)).alias("left"), F.left(m["gaps"][i + 1], F.lit(RIGHT)).alias("right"))))
        return F.filter(spans, lambda s: rule(s["span"]))

    pieces = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
                      F.split(text, pattern, -1).alias("gaps"))
    return F.when(text.rlike(needs), let(pieces, placed)).otherwise(F.array()).cast(MATCH)


# ---- labelers and features -----------------------------------------------------

def _signals(k: Kind, s: Column) -> dict[str, Column]:
    left, right, span = s["left"], s["right"], s["span"]
    return {
        "rule": k.rule(span), "format": span.rlike(k.canonical), "gazetteer": k.gazetteer(span),
        "left_clean": ~left.rlike(r"[0-9A-Za-z_=/@:+\"'-]$"), "right_clean": ~right.rlike(r"^[0-9A-Za-z_=/@\"'-]"),
        "left_yes": left.rlike(k.left_yes), "left_no": left.rlike(k.left_no), "right_no": right.rlike(k.right_no),
        "separated": span.rlike("[ -]"), "digits_before": left.rlike("[0-9][ -]?$"),
        "digits_after": right.rlike("^[ -]?[0-9]"),
    }


def votes(x: Column) -> Column:
    """A letter a labeler: y, n or - (nothing to say)."""
    say = lambda yes, no: F.when(no, "n").when(yes, "y").otherwise("-")
    never = F.lit(False)
    return F.concat(
        say(x["format"], never), say(x["rule"], ~x["rule"]), say(x["gazetteer"], ~x["gazetteer"]),
        say(x["left_yes"], x["left_no"]), say(never, ~x["left_clean"] | ~x["right_clean"]),
        say(never, x["right_no"]))


def candidates(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row for each row of ``docs``: ``kept``, a struct of the columns
    ``keep``, ``base`` and ``proposed``, arrays of (kind, start, end, votes,
    features); the kind is its place in KINDS. Proposals don't overlap base
    spans of their kind."""
    keep = docs.columns if keep is None else keep
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))

    def judged(i: int, k: Kind, spans: Column) -> Column:
        def one(s: Column) -> Column:
            signals = F.struct(*[c.alias(n) for n, c in _signals(k, s).items()])
            return let(signals, lambda x: F.struct(
                F.lit(i).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), votes(x).alias("votes"),
                F.concat(*[x[f].cast("int").cast("string") for f in FEATURES]).alias("features")))
        return F.transform(spans, one)

    def apart(base: Column, proposed: Column) -> Column:
        """The proposals that no base span of their kind overlaps: along the
        order of places, the last base end before and the first base start after."""
        def kept(both: Column) -> Column:
            rank = lambda s, c: s["span"]["kind"].cast("bigint") * PLACE + s["span"][c]
            held = lambda c, none: F.transform(
                both, lambda s: F.when(s["is_base"], rank(s, c)).otherwise(none))
            before = prefixes(held("end", -1), F.lit(-1).cast("bigint"), F.greatest)
            after = F.reverse(prefixes(F.reverse(held("start", 2 ** 62)), F.lit(2 ** 62), F.least))
            ends = F.struct(before.alias("before"), after.alias("after"))
            free = let(ends, lambda e: F.transform(both, lambda s, i: F.struct(
                s["span"].alias("span"), (~s["is_base"] & (e["before"][i] <= rank(s, "start"))
                                          & (e["after"][i + 1] >= rank(s, "end"))).alias("free"))))
            return F.transform(F.filter(free, lambda s: s["free"]), lambda s: s["span"])

        marked = lambda spans, is_base: F.transform(spans, lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), F.lit(is_base).alias("is_base"), s.alias("span")))
        return F.when(F.size(proposed) > 0,
                      let(F.array_sort(F.concat(marked(base, True), marked(proposed, False))), kept)).otherwise(proposed)

    def both(t: Column) -> Column:
        spans = {
            "base": [judged(i, KIND[k], matches(t, KIND[k].base, KIND[k].needs, KIND[k].base_rule)) for i, k in enumerate(KINDS)],
            "proposed": [judged(i, KIND[k], matches(t, KIND[k].propose, KIND[k].propose_needs, lambda s: F.lit(True)))
                         for i, k in enumerate(KINDS)]}
        return let(F.struct(*[F.concat(*v).alias(n) for n, v in spans.items()]),
                   lambda s: F.struct(s["base"].alias("base"), apart(s["base"], s["proposed"]).alias("proposed")))

    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), let(whole, both).alias("spans"))
    return found.select("kept", "spans.base", "spans.proposed")


# ---- label model and classifier --------------------------------------------------

@dataclass
class LabelModel:
    """Of one kind: the share of personal data among the candidates and each
    labeler's reliability, the chance that a vote it gives is right."""
    share: float
    reliability: dict[str, float]

    def likelihood(self, pattern: str) -> float:
        score = math.log(self.share / (1 - self.share))
        for name, vote in zip(LABELERS, pattern):
            if vote != "-":
                r = self.reliability[name]
                score += math.log(r / (1 - r)) * (1 if vote == "y" else -1)
        return 1 / (1 + math.exp(-score))


def estimate(counts: dict[str, int]) -> LabelModel:
    """Expectation-maximisation over vote patterns and how often each occurs.
    Labelers are taken to err independently, as often on either side; a vote
    not given says nothing. The share of personal data is held to be one half,
    again as if as many candidates had shown it, so that a corpus of nothing
    but true ones does not carry a candidate that the labelers reject."""
    prior = {name: PRIOR.get(name, 0.7) for name in LABELERS}
    model = LabelModel(0.5, dict(prior))
    total = sum(counts.values())
    bound = lambda x: min(max(x, 1e-3), 1 - 1e-3)
    for _ in range(ROUNDS):
        likely = {p: model.likelihood(p) for p in counts}
        right = {name: prior[name] * (total + 1) for name in LABELERS}
        given = dict.fromkeys(LABELERS, float(total + 1))
        for p, n in counts.items():
            for name, vote in zip(LABELERS, p):
                if vote != "-":
                    right[name] += n * (likely[p] if vote == "y" else 1 - likely[p])
                    given[name] += n
        share = (sum(n * likely[p] for p, n in counts.items()) + 0.5 * (total + 1)) / (2 * total + 1)
        new = LabelModel(share, {name: bound(right[name] / given[name]) for name in LABELERS})
        moved = max(abs(new.share - model.share), *(abs(new.reliability[x] - model.reliability[x]) for x in LABELERS))
        model = new
        if moved < 1e-10:
            break
    return model


def logistic(rows: list[tuple[str, float, float]], ridge: float = RIDGE) -> list[float]:
    """Bias and weights from (features, weight of ones, weight of all), by
    Newton steps."""
    x = np.array([[1.0] + [float(b == "1") for b in f] for f, _, _ in rows])
    ones, all_ = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    w = np.zeros(x.shape[1])
    hold = np.full(x.shape[1], ridge)

    def loss(w):
        z = x @ w
        return float(np.sum(all_ * np.logaddexp(0, z) - ones * z) + 0.5 * np.sum(hold * w * w))

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (all_ * p * (1 - p))[:, None]).T @ x + np.diag(hold), x.T @ (ones - all_ * p) - hold * w)
        size, at = 1.0, loss(w)
        while loss(w + size * step) > at and size > 1e-6:
            size /= 2
        w = w + size * step
        if np.max(np.abs(size * step)) < 1e-10:
            break
    return w.tolist()


@dataclass
class Model:
    labels: dict[str, LabelModel]
    weights: dict[str, list[float]]

    def score(self, span: Column) -> Column:
        """Chance that a candidate (kind, features) is personal data."""
        chosen = F.lit(0.0)
        for i, k in enumerate(KINDS):
            w = self.weights.get(k)
            if w:
                z = F.lit(w[0])
                for j, x in enumerate(w[1:], 1):
                    z = z + F.when(F.substring(span["features"], j, 1) == "1", F.lit(x)).otherwise(F.lit(0.0))
                chosen = F.when(span["kind"] == i, 1 / (1 + F.exp(-z))).otherwise(chosen)
        return chosen


def train(found: DataFrame) -> Model:
    """The model of the candidates in ``found`` (stored rows of ``candidates``)."""
    every = found.select(F.explode(F.concat("base", "proposed")).alias("s")).select("s.*")
    counts: dict[str, dict[str, int]] = {}
    for r in every.groupBy("kind", "votes").count().collect():
        counts.setdefault(KINDS[r["kind"]], {})[r["votes"]] = r["count"]
    labels = {k: estimate(c) for k, c in sorted(counts.items())}
    likely = [v for k, c in sorted(counts.items()) for p in sorted(c)
              for v in (F.lit(f"{KINDS.index(k)}{p}"), F.lit(labels[k].likelihood(p)))]
    weights: dict[str, list] = {}
    if likely:
        chance = F.create_map(*likely)[F.concat(F.col("kind").cast("string"), F.col("votes"))]
        rows = every.groupBy("kind", "features").agg(F.sum(chance).alias("ones"), F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(rows, key=lambda r: (r["kind"], r["features"])):
            weights.setdefault(KINDS[r["kind"]], []).append((r["features"], r["ones"], r["n"]))
    return Model(labels, {k: logistic(r) for k, r in weights.items()})


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row for each row of ``docs``: the columns ``keep`` (all), then
    ``base`` and ``added`` (in place of kept columns of these names), arrays of
    (kind, start, end, score), ordered by kind and start; places are in code
    points, ends exclusive. Nothing is dropped from ``base`` by its score."""
    keep = docs.columns if keep is None else keep
    found = stored(candidates(docs, text, keep), "pii_candidates")
    model = train(found)
    spans = lambda c: F.transform(c, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), model.score(s).alias("score")))
    return found.select(*[F.col(f"kept.`{c}`") for c in keep if c.lower() not in ("base", "added")],
                        spans(F.col("base")).alias("base"),
                        F.filter(spans(F.col("proposed")), lambda s: s["score"] >= THRESHOLD).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end of spans in order, comma-joined."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")
