"""Language ID by multilingual mixture inference.

``train`` counts character trigrams of every training text for each
language. ``predict`` explains each text as a mixture of languages: the
proportions are estimated by expectation-maximisation from the trigrams'
likelihoods, and the set of languages grows while the penalised likelihood
(half the logarithm of the trigram count for each further language) does.
The language of the largest proportion is the prediction.

The model is one array of languages x trigram slots. Slots are chosen so
that it never exceeds ``MODEL_CELLS`` numbers, whatever the corpus; only
these per-slot sums reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import arrow_batches, fresh, map_texts

MODEL_CELLS = 1 << 23    # languages x slots, at most (32 MB of float32)
SLOT_BITS = (16, 8)      # slots are 2 to this power, the largest that fits
PIECE = 1 << 16          # characters that are held as trigrams at a time
MAX_STEPS = 200          # expectation-maximisation steps for one set
TOLERANCE = 0.05         # log-likelihood left to gain when a fit ends
UNDETERMINED = "und"

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Code point -> itself if it is a letter, else a space."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((c if chr(c).isalpha() else 32 for c in range(0x110000)),
                               dtype=np.uint32, count=0x110000)
    return _letters


def trigrams(text: str | None, bits: int) -> np.ndarray:
    """Slots of the trigrams of the lower-cased letters of a whole text;
    anything else separates words and is read as one space."""
    if not text:
        return np.empty(0, dtype=np.int64)
    codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    codes = _letter_table()[codes]
    codes = np.concatenate(([32], codes, [32])).astype(np.uint32)
    mid = np.flatnonzero(codes[1:-1] != 32) + 1
    key = (codes[mid - 1] * np.uint32(0x9E3779B1) ^ codes[mid] * np.uint32(0x85EBCA77)
           ^ codes[mid + 1] * np.uint32(0xC2B2AE3D))
    key ^= key >> np.uint32(15)
    key *= np.uint32(0x27D4EB2F)
    return (key >> np.uint32(32 - bits)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    bits: int
    p: np.ndarray          # slots x languages: smoothed probabilities


def train(docs: DataFrame, where: Column, text: str = "text", lang: str = "lang") -> Model:
    """Count the trigrams of all texts that ``where`` admits and whose lang
    is not null. No such text leaves a model without languages."""
    arrow_batches(docs.sparkSession)
    known = docs.where(where & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    languages = sorted(r["lang"] for r in known.select("lang").distinct().limit(MODEL_CELLS).collect())
    fits = [b for b in range(SLOT_BITS[1], SLOT_BITS[0] + 1) if len(languages) << b <= MODEL_CELLS]
    if not fits:
        raise ValueError(f"{len(languages)} languages are more than the model holds")
    bits = fits[-1]

    def count(batches):
        sums: dict = {}
        for b in batches:
            for name, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                slots = trigrams(t, bits)
                if name not in sums:
                    sums[name] = np.zeros(1 << bits, dtype=np.int64)
                if len(slots):
                    sums[name] += np.bincount(slots, minlength=1 << bits)
        for name, v in sums.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                 pa.array(v[at])], ["lang", "slot", "n"])

    rows = (known.mapInArrow(count, "lang string, slot int, n bigint")
            .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas())
    n = np.zeros((1 << bits, len(languages)))
    place = {x: i for i, x in enumerate(languages)}
    if len(rows):
        n[rows["slot"].to_numpy(), rows["lang"].map(place).to_numpy()] = rows["n"].to_numpy()
    # Half a count for each slot that any language uses; other slots tell nothing.
    used = n.any(axis=1, keepdims=True)
    n = np.where(used, n + 0.5, 1.0)
    return Model(languages, bits, (n / n.sum(axis=0)).astype(np.float32))


def infer(model: Model, text: str | None) -> tuple[str, float, list[tuple[str, float]]]:
    """The main language, its proportion, and all languages of the text with
    their proportions. No letter or no model: ``und``, 0, none."""
    slots = trigrams(text, model.bits)
    if not len(slots) or not model.languages:
        return UNDETERMINED, 0.0, []
    if len(slots) > PIECE:      # a very long text: weigh distinct slots instead of places
        uniq, times = np.unique(slots, return_counts=True)
        p = model.p[uniq].astype(np.float64)
        return _select(model, p, times.astype(np.float64))
    return _select(model, model.p[slots].astype(np.float64), None)


def _fit(p: np.ndarray, w: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """EM from ``start``: proportions and log-likelihood of trigrams with
    weights ``w`` and language probabilities ``p`` (trigrams x languages)."""
    share = start / start.sum()
    n = w.sum()
    for _ in range(MAX_STEPS):
        slope = (w / (p @ share)) @ p / n          # of the mean log-likelihood, by language
        if n * (slope.max() - 1.0) <= TOLERANCE:   # bounds what is left to gain
            break
        share = share * slope
        share /= share.sum()
    return share, float(w @ np.log(p @ share))


def _select(model: Model, p: np.ndarray, times: np.ndarray | None):
    """Grow the set of languages from the best single one. A language is
    tried only if the slope shows that it may gain more than the penalty."""
    w = np.ones(len(p)) if times is None else times
    n = w.sum()
    penalty = 0.5 * np.log(n)
    single = w @ np.log(p)
    chosen = [int(np.argmax(single))]
    share, like = np.ones(1), float(single[chosen[0]])
    while len(chosen) < p.shape[1]:
        mix = p[:, chosen] @ share
        slope = (w / mix) @ p - n              # an upper bound of any gain, by language
        slope[chosen] = -np.inf
        best = None
        for k in np.argsort(-slope, kind="stable"):
            if slope[k] <= penalty:
                break
            trial = chosen + [int(k)]
            got = _fit(p[:, trial], w, np.append(share * 0.9, 0.1))
            if got[1] - like > penalty and (best is None or got[1] > best[2]):
                best = (trial, *got)
        if best is None:
            break
        chosen, share, like = best
    order = sorted(range(len(chosen)), key=lambda i: (-share[i], model.languages[chosen[i]]))
    found = [(model.languages[chosen[i]], float(share[i])) for i in order]
    return found[0][0], min(1.0, max(0.0, found[0][1])), found


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
            prefix: str = "") -> DataFrame:
    """Columns ``keep``, then lang_pred, score (the main language's
    proportion) and languages (all of them, largest first), each with
    ``prefix``.

    Texts that are null or hold no letter get ``und``, 0 and an empty list;
    ties go to the language first in order of its name; repeated rows are
    predicted each. Only the text is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def run(texts):
            got = [infer(m, t) for t in texts]
            return [[g[0] for g in got], [g[1] for g in got],
                    [[{"lang": a, "share": b} for a, b in g[2]] for g in got]]
        return run

    return map_texts(docs, text, ["doc_id"] if keep is None else keep,
                     [(f"{prefix}lang_pred", "string"), (f"{prefix}score", "double"),
                      (f"{prefix}languages", "array<struct<lang:string,share:double>>")], make)


def keep_identified(docs: DataFrame, model: Model, least_share: float = 0.0,
                    text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text has an
    identified language, in whatever mixture; ``least_share`` asks for a main
    one of at least that proportion. A model without languages rejects none of
    the texts that hold a letter."""
    if not model.languages:
        return docs.where(F.col(f"`{text}`").rlike(r"\p{L}"))
    prefix = fresh([f"{c}" for c in docs.columns], "_li")
    found = predict(docs, model, text, docs.columns, prefix)
    return (found.where((F.col(f"{prefix}lang_pred") != UNDETERMINED)
                        & (F.col(f"{prefix}score") >= least_share)).select(*docs.columns))
