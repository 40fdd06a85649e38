"""Interpolated modified Kneser-Ney model of any order from 2 on, counted in Spark.

A *block* is what one task reads of the documents. Its distinct n-grams and
words (64-bit hashes, sorted) go to the shards of a grid: an n-gram, as a
pair of its context (all words but the last) and its last word, to the shard
of the leading bits of both hashes, a word to the shard of its own leading
bits. So neither a frequent context nor a frequent word meets in one task,
and all counts of a block travel added up. Every order from 2 up has the
same layout of pairs; the highest is counted first, as each order's
continuation counts come from the next higher one.

Each pair shard merges its blocks to sorted hash arrays (keys and
counts), maps these arrays of its own into memory from a spooled
file and looks up every block's pairs there; the arrays aren't stored. Each word shard does the
same with word counts, continuation counts and context sums, and from order
3 on a shard of contexts with the context sums alone. The answers
go back to the blocks, and a second run over the blocks' texts turns them
into probabilities with the discounts that the shards' counts of counts
give.

A text begins with one begin mark: its first words have the contexts that
there are. An n-gram that begins with the mark has nothing on its left, so
its plain count stands for its continuation count.

Blocks, shards and answers are compressed arrays in few rows; a shard's
size is set by ``SHARD_TOKENS``, whatever the corpus. Only some sums by
shard reach the driver.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tickwise.llm.common import arrow_batches
from tickwise.session import stored

SHARD_TOKENS = 1 << 22    # tokens for each shard, at most
BLOCK_TOKENS = 3 << 19    # tokens after which a task begins a new block
BYTES_PER_TOKEN = 6
BEGIN, END = b" <s>", b" </s>"     # no word holds a space
_LOW40 = np.uint64((1 << 40) - 1)


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 3)


class _Places(dict):
    """Numbers words in the order in which they come."""
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


@dataclass
class Level:
    """A block's n-grams of one order, as pairs of context and word."""
    contexts: np.ndarray   # sorted distinct hashes (order 2: the block's words)
    rests: np.ndarray      # hashes of the contexts without their first word (order 2: none)
    begins: np.ndarray     # whether a context begins with BEGIN
    pairs: np.ndarray      # sorted distinct (context place << 32 | word place)
    pair_n: np.ndarray     # their counts in training texts
    of: np.ndarray         # the place in ``pairs`` of each token, -1 before there is such a context


@dataclass
class Block:
    words: np.ndarray      # sorted distinct hashes, BEGIN and END among them
    word_n: np.ndarray     # their counts in training texts (BEGIN: none)
    word: np.ndarray       # the word of each token
    ends: np.ndarray       # where each text's tokens end
    levels: list[Level]    # orders 2, 3, ...


def _gram_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a context and one more word."""
    h = context * np.uint64(0x9E3779B97F4A7C15) + word
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ h >> np.uint64(shift)) * np.uint64(by)
    return h ^ h >> np.uint64(31)


def block_of(texts: list[bytes | None], train: list[bool], order: int = 2, learn: bool = True) -> Block:
    """The block of these texts; without ``learn`` its training counts are left
    out (None). Places are 4 bytes: a block has fewer tokens than that."""
    places = _Places()
    begin, end = places[BEGIN], places[END]
    parts, ends, n = [], [], 0
    for t in texts:
        words = t.lower().split() if t else []         # ASCII case and white space
        parts.append(np.array([begin, *map(places.__getitem__, words), end], dtype=np.int32))
        n += len(words) + 1
        ends.append(n)
    hashes = np.fromiter(map(_hash, places), dtype=np.uint64, count=len(places))
    del places
    words, place = np.unique(hashes, return_inverse=True)
    place = place.astype(np.int32)
    word = np.concatenate([place[p[1:]] for p in parts])
    context = np.concatenate([place[p[:-1]] for p in parts])
    del parts, hashes
    ends = np.array(ends, dtype=np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    since = np.arange(n, dtype=np.int32)                        # tokens before it in its text
    since -= np.repeat(starts.astype(np.int32), ends - starts)
    known = np.repeat(np.array(train, dtype=bool), ends - starts) if learn else None
    contexts, rests, begins = words, np.empty(0, np.uint64), np.zeros(len(words), bool)
    begins[place[begin]] = True
    levels: list[Level] = []
    for k in range(2, order + 1):
        there = np.flatnonzero(since >= k - 2) if k > 2 else slice(None)
        if k > 2:                   # a context is the n-gram, one order lower, of the token before
            low = levels[-1]
            grams = _gram_hash(low.contexts[low.pairs >> 32], words[low.pairs & 0xFFFFFFFF])
            before, now = low.of[there - 1], low.of[there]
            contexts, first, found = np.unique(grams[before], return_index=True, return_inverse=True)
            context = np.zeros(n, np.int32)
            context[there] = found
            rests = low.contexts[low.pairs[now[first]] >> 32]
            begins = since[there[first]] == k - 2
        at = context[there].astype(np.int64) << 32 | word[there]
        pairs, found = np.unique(at, return_inverse=True)
        del at
        found = found.astype(np.int32)
        pair_n = np.bincount(found[known[there]], minlength=len(pairs)) if learn else None
        if k > 2:
            of = np.full(n, -1, np.int32)
            of[there] = found
        else:
            of = found
        levels.append(Level(contexts, rests, begins, pairs, pair_n, of))
    word_n = np.bincount(word[known], minlength=len(words)).astype(np.int64) if learn else None
    return Block(words, word_n, word, ends, levels)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string."""
    head = np.array([len(arrays), *(x for a in arrays for x in (a.dtype.num, len(a)))], dtype=np.int64)
    return zstandard.ZstdCompressor(level=3).compress(
        b"".join([head.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)]))


_KINDS = {np.dtype(t).num: np.dtype(t) for t in (np.uint8, np.uint16, np.uint32, np.uint64, np.int64, np.float64)}


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    many = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * many, 8).reshape(many, 2)
    out, at = [], 8 + 16 * many
    for kind, n in head.tolist():
        out.append(np.frombuffer(raw, _KINDS[kind], n, at))
        at += n * _KINDS[kind].itemsize
    return out


def _small(a: np.ndarray) -> np.ndarray:
    """Counts in the narrowest unsigned type that holds them."""
    top = int(a.max(initial=0))
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else
                    np.uint32 if top < 1 << 32 else np.uint64)


def _split40(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leading 40 bits of hashes, in 32 and 8."""
    return (h >> np.uint64(32)).astype(np.uint32), (h >> np.uint64(24)).astype(np.uint8)


def _join40(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return high.astype(np.uint64) << np.uint64(8) | low.astype(np.uint64)


def _word_bits(bits: int) -> int:
    """Of a shard's bits, those that the second word gives: few, as a context
    is written once in each shard that holds it."""
    return bits // 3


def _lead(hashes: np.ndarray, n: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - n)).astype(np.int64) if n else np.zeros(len(hashes), np.int64)


def pair_shards(contexts: np.ndarray, words: np.ndarray, pairs: np.ndarray,
                bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """Shard and places (in ``pairs``, in order) of its pairs."""
    by_word = _word_bits(bits)
    shard = (_lead(contexts, bits - by_word) << by_word)[pairs >> 32] | _lead(words, by_word)[pairs & 0xFFFFFFFF]
    order = np.argsort(shard, kind="stable")
    edges = np.searchsorted(shard[order], np.arange((1 << bits) + 1))
    for s, (i, j) in enumerate(zip(edges, edges[1:])):
        if i < j:
            yield s, order[i:j]


def word_shards(words: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """Shard and range of sorted word hashes."""
    if not bits:
        yield 0, 0, len(words)
        return
    step = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    edges = [0, *np.searchsorted(words, step).tolist(), len(words)]
    for s, (i, j) in enumerate(zip(edges, edges[1:])):
        if i < j:
            yield s, i, j


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))) if len(sorted_keys) \
        else np.empty(0, dtype=np.int64)


def _sum_by(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys, sorted, and the sums of the values."""
    order = np.argsort(keys, kind="stable")
    at = _runs(keys[order])
    out = [keys[order][at]]
    for v in values:
        out.append(np.add.reduceat(v[order].astype(np.int64), at) if len(at) else np.empty(0, np.int64))
    return out


def mapped(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays, mapped read-only from a spooled file. The file has no name
    left once it is mapped: nothing stays behind when the task ends."""
    with tempfile.NamedTemporaryFile() as f:
        for a in arrays:
            f.write(np.ascontiguousarray(a).tobytes())
            f.write(b"\0" * (-f.tell() % 8))
        f.flush()
        out, at = [], 0
        for a in arrays:
            out.append(np.memmap(f.name, dtype=a.dtype, mode="r", offset=at, shape=a.shape) if len(a) else a)
            at += -(-a.nbytes // 8) * 8
    return out


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of wanted keys in a sorted array, and which are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _looked_up(keys: np.ndarray, wanted: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Values of wanted keys in a sorted array, 0 for those not there."""
    at, there = _found(keys, wanted)
    return [np.where(there, v[at], 0) if len(keys) else np.zeros(len(wanted), np.int64) for v in values]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds, shards, blocks, data = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds, pa.string()), pa.array(shards, pa.int32()), pa.array(blocks, pa.string()),
         pa.array(data, pa.binary())], ["kind", "shard", "block", "data"])


_ROWS = "kind string, shard int, block string, data binary"


def _grouped(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[tuple[object, list[tuple]]]:
    """Rows that come sorted by column ``key``, by its value."""
    now, rows = None, []
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns)):
            if rows and r[key] != now:
                yield now, rows
                rows = []
            now = r[key]
            rows.append(r)
    if rows:
        yield now, rows


def merge_pairs(shard: int, rows: list[tuple], bits: int, order: int) -> Iterator[tuple]:
    """One shard of pairs of one order: answers to the blocks, and what it
    knows of contexts, continuations and counts of counts."""
    asked = [(r[2], *unpack(r[3])) for r in rows if r[0] == "pairs"]
    for r in rows:
        if r[0] == "words":         # on their way to the word shards
            yield r
    if not asked:
        return
    heads = [_join40(a[1], a[2]) for a in asked]
    contexts, first = np.unique(np.concatenate(heads), return_index=True)
    keys = [np.repeat(np.searchsorted(contexts, v).astype(np.uint64), runs) << np.uint64(40) | _join40(hi, lo)
            for v, (_, _, _, runs, hi, lo, *_) in zip(heads, asked)]
    # continuation counts, from the next higher order
    more = [(_join40(*x[0:2]), _join40(*x[2:4]), x[4]) for x in (unpack(r[3]) for r in rows if r[0] == "follows")]
    pairs, n = _sum_by(
        np.concatenate([*keys, *(np.searchsorted(contexts, v).astype(np.uint64) << np.uint64(40) | w
                                 for v, w, _ in more)]),
        np.concatenate([*(a[6] for a in asked), *(x[2] for x in more)]))
    pairs, n = pairs[n > 0], n[n > 0]
    pairs, n = mapped(pairs, n)
    for (block, *_), wanted in zip(asked, keys):
        yield f"pair_n{order}", shard, block, pack(_small(*_looked_up(pairs, wanted, n)))
    yield f"stat{order}", shard, "", pack(np.array([np.count_nonzero(n == k) for k in (1, 2, 3, 4)], dtype=np.int64))
    of, *sums = _sum_by(pairs >> np.uint64(40), n, n == 1, n == 2, n >= 3)
    v = contexts[of.astype(np.int64)]
    for s, i, j in word_shards(v << np.uint64(24), bits):
        yield "contexts", s, "", pack(v[i:j], *(_small(x[i:j]) for x in sums))
    if order == 2:
        w, times = np.unique(pairs & _LOW40, return_counts=True)
        for s, i, j in word_shards(w << np.uint64(24), bits):
            yield "follows", s, "", pack(w[i:j], _small(times[i:j]))
        return
    rests, place = np.unique(np.concatenate([_join40(a[7], a[8]) for a in asked])[first], return_inverse=True)
    grams, times = np.unique(place.astype(np.uint64)[(pairs >> np.uint64(40)).astype(np.int64)] << np.uint64(40)
                             | pairs & _LOW40, return_counts=True)
    v, w = rests[(grams >> np.uint64(40)).astype(np.int64)], grams & _LOW40
    by_word = _word_bits(bits)
    to = _lead(v << np.uint64(24), bits - by_word) << by_word | _lead(w << np.uint64(24), by_word)
    at = np.argsort(to, kind="stable")
    for x in np.split(at, np.flatnonzero(np.diff(to[at])) + 1):
        if len(x):
            yield "follows", int(to[x[0]]), "", pack(*_split40(v[x] << np.uint64(24)),
                                                     *_split40(w[x] << np.uint64(24)), _small(times[x]))


def merge_contexts(shard: int, rows: list[tuple], order: int) -> Iterator[tuple]:
    """One shard of contexts of two words or more: answers of their sums to the blocks."""
    asked = [(r[2], _join40(*unpack(r[3]))) for r in rows if r[0] == "words"]
    sums = [unpack(r[3]) for r in rows if r[0] == "contexts"]
    v, *columns = _sum_by(*(np.concatenate([x[k] for x in sums]) for k in range(5))) if sums else \
        [np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(4))]
    v, *columns = mapped(v, *columns)
    for block, wanted in asked:
        yield f"word_n{order}", shard, block, pack(*map(_small, _looked_up(v, wanted, *columns)))


def merge_words(shard: int, rows: list[tuple]) -> Iterator[tuple]:
    """One word shard: counts, continuation counts and context sums of its
    words, answers to the blocks, and totals."""
    asked = [(r[2], *unpack(r[3])) for r in rows if r[0] == "words"]
    if not asked:
        return
    words, n = _sum_by(np.concatenate([a[1] for a in asked]), np.concatenate([a[2] for a in asked]))
    columns = [n, *(np.zeros(len(words), np.int64) for _ in range(5))]
    follows = [unpack(r[3]) for r in rows if r[0] == "follows"]
    if follows:
        w, a = _sum_by(np.concatenate([x[0] for x in follows]), np.concatenate([x[1] for x in follows]))
        columns[1:2] = _looked_up(w, words >> np.uint64(24), a)
    contexts = [unpack(r[3]) for r in rows if r[0] == "contexts"]
    if contexts:
        v, *sums = _sum_by(np.concatenate([x[0] for x in contexts]),
                           *(np.concatenate([x[k] for x in contexts]) for k in (1, 2, 3, 4)))
        columns[2:] = _looked_up(v, words >> np.uint64(24), *sums)
    a = columns[1]
    yield "stat1", shard, "", pack(np.array(
        [n.sum(), np.count_nonzero(n), a.sum(), *(np.count_nonzero(a == k) for k in (1, 2, 3, 4)),
         np.count_nonzero(a >= 3)], dtype=np.int64))
    words, *columns = mapped(words, *columns)
    for block, w, _ in asked:
        at, _ = _found(words, w)
        yield "word_n2", shard, block, pack(*(_small(np.asarray(c[at])) for c in columns))


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """What is taken off counts 0, 1, 2 and from 3 on. Where counts of counts
    are missing (small corpora), each at least 0 and at most its count."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    d = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(x, 0.05), 0.95 * k) for k, x in enumerate(d, 1))])


@dataclass(frozen=True)
class Totals:
    """Sums over all shards."""
    tokens: int            # in training texts
    words: int             # distinct ones
    follows: int           # distinct bigrams, by their second word
    high: list[np.ndarray]  # discounts of the counts of orders 2, 3, ...
    low: np.ndarray        # discounts of continuation counts of words
    spread: float          # what the lowest order leaves to the uniform share

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 1) / (self.tokens + self.words + 1))

    def lowest(self, n_follow: np.ndarray) -> np.ndarray:
        """Probability of words by their continuation counts."""
        lower = np.full(len(n_follow), self.spread / (self.words + 1))
        if self.follows:
            lower = lower + np.maximum(n_follow - self.low[np.minimum(n_follow, 3)], 0) / self.follows
        return lower

    def higher(self, order: int, pair_n, context, once, twice, more, lower) -> np.ndarray:
        """Probability of n-grams, from what the shards answer: the n-gram's
        count, the context's sum and how many words follow it once, twice,
        more often; and the probability one order lower."""
        high = self.high[order - 2]
        left = high[1] * once + high[2] * twice + high[3] * more
        own = np.maximum(pair_n - high[np.minimum(pair_n, 3)], 0)
        sure = np.maximum(context, 1)
        return np.where(context > 0, own / sure + left / sure * lower, lower)


def totals(one: np.ndarray, high: list[np.ndarray]) -> Totals:
    tokens, words, follows, n1, n2, n3, n4, more = (int(x) for x in one)
    low = discounts(n1, n2, n3, n4)
    spread = (low[1] * n1 + low[2] * n2 + low[3] * more) / follows if follows else 1.0
    return Totals(tokens, words, follows, [discounts(*(int(x) for x in h)) for h in high], low, spread)


def fit_and_score(docs: DataFrame, train: Column, text: str = "text", id_col: str = "doc_id",
                  shard_tokens: int = SHARD_TOKENS, block_tokens: int = BLOCK_TOKENS,
                  order: int = 2) -> DataFrame:
    """Learn n-grams of up to ``order`` words from the rows that ``train``
    admits and score every row.

    Returns doc_id, learned (whether ``train`` admitted it), n_tokens (words
    and one end), n_known (tokens seen in training), train_tokens,
    base_score and score (log10 probability of the whole text).

    A null or empty text is one token, its end. Repeated rows count and are
    scored each. Without training rows every token has the uniform share.
    No rows: none. Words are told apart by 64-bit hashes, within
    n-grams by their leading 40 bits, and so are contexts.
    """
    if order < 2:
        raise ValueError("the order is at least 2")
    spark = docs.sparkSession
    arrow_batches(spark)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(train, F.lit(False)).alias("learned"),
                         F.col(text).cast("string").cast("binary").alias("text"))
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    tokens = size / BYTES_PER_TOKEN
    bits = 0
    while shard_tokens << bits < tokens * (order - 1):     # higher orders have more distinct n-grams
        bits += 1
    shards = 1 << bits
    ids_type = picked.schema["doc_id"].dataType.simpleString()

    # The blocks: their texts in one row each, so that both runs see the same.
    def cut(batches):
        ids, learned, texts, held, k = [], [], [], 0, 0
        task = TaskContext.get()

        def row(k):
            name = f"{task.partitionId()}-{k}"
            lengths = np.array([-1 if t is None else len(t) for t in texts], dtype=np.int64)
            data = pack(lengths, np.frombuffer(b"".join(t or b"" for t in texts), dtype=np.uint8))
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([ids], pa.list_(id_arrow)),
                 pa.array([learned], pa.list_(pa.bool_())), pa.array([data], pa.binary())],
                ["block", "ids", "learned", "data"])

        id_arrow = None
        for b in batches:
            id_arrow = b.column(0).type
            for i, y, t in zip(*(c.to_pylist() for c in b.columns)):
                ids.append(i)
                learned.append(y)
                texts.append(t)
                held += len(t or b"") + BYTES_PER_TOKEN
                if held >= block_tokens * BYTES_PER_TOKEN:
                    yield row(k)
                    ids, learned, texts, held, k = [], [], [], 0, k + 1
        if ids:
            yield row(k)

    blocks = stored(picked.mapInArrow(
        cut, f"block string, ids array<{ids_type}>, learned array<boolean>, data binary"), "lm_blocks")

    def texts_of(data: bytes) -> list[bytes | None]:
        lengths, raw = unpack(data)
        raw, out, at = raw.tobytes(), [], 0
        for n in lengths.tolist():
            out.append(None if n < 0 else raw[at:at + n])
            at += max(n, 0)
        return out

    def count(k):
        def run(batches):
            for batch in batches:
                for name, learned, data in zip(*(c.to_pylist() for c in batch.columns)):
                    b = block_of(texts_of(data), learned, k)
                    x = b.levels[-1]
                    pair_n = x.pair_n if k == order else np.where(x.begins[x.pairs >> 32], x.pair_n, 0)
                    for s, at in pair_shards(x.contexts, b.words, x.pairs, bits):
                        v, w = x.pairs[at] >> 32, b.words[x.pairs[at] & 0xFFFFFFFF]
                        first = _runs(v)
                        runs = np.diff(first, append=len(v))
                        v = v[first]
                        rest = _split40(x.rests[v]) if k > 2 else ()
                        yield _batch([("pairs", s, name, pack(
                            *_split40(x.contexts[v]), _small(runs), *_split40(w), _small(pair_n[at]), *rest))])
                    for s, i, j in word_shards(x.contexts, bits):
                        yield _batch([("words", s, name, pack(b.words[i:j], _small(b.word_n[i:j])) if k == 2
                                       else pack(*_split40(x.contexts[i:j])))])
        return run

    def by_shard(rows: DataFrame) -> DataFrame:
        return rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "kind", "block")

    def merged(merge, *args):
        def run(batches):
            for s, rows in _grouped(batches, 1):
                for r in merge(s, rows, *args):
                    yield _batch([r])
        return run

    def sums(rows: DataFrame, kind: str, n: int) -> np.ndarray:
        got = [unpack(r["data"])[0] for r in rows.where(F.col("kind") == kind).select("data").collect()]
        return np.sum(got, axis=0) if got else np.zeros(n, dtype=np.int64)

    follows, answers, high = None, [], []
    for k in range(order, 1, -1):
        counted = blocks.select("block", "learned", "data").mapInArrow(count(k), _ROWS)
        counted = counted if follows is None else counted.unionByName(follows)
        level = stored(by_shard(counted).mapInArrow(merged(merge_pairs, bits, k), _ROWS), f"lm_pairs{k}")
        follows = level.where("kind = 'follows'")
        up = level.where(F.col("kind").isin("words", "contexts", *(["follows"] if k == 2 else [])))
        tops = merged(merge_words) if k == 2 else merged(merge_contexts, k)
        level1 = stored(by_shard(up).mapInArrow(tops, _ROWS), f"lm_words{k}")
        answers += [level.where(F.col("kind") == f"pair_n{k}"), level1.where(F.col("kind") == f"word_n{k}")]
        high.insert(0, sums(level, f"stat{k}", 4))

    t = totals(sums(level1, "stat1", 8), high)

    # A block's answers are few, small rows; its texts meet them in one task.
    answers = reduce(DataFrame.unionByName, answers).select("block", "kind", "shard", "data")
    nothing = [F.lit(None).cast(f"array<{ids_type}>").alias("ids"), F.lit(None).cast("array<boolean>").alias("learned")]
    asked = blocks.select("block", F.lit("texts").alias("kind"), F.lit(0).alias("shard"), "data", "ids", "learned")
    met = asked.unionByName(answers.select("*", *nothing)).repartition("block").sortWithinPartitions("block", "kind", "shard")

    id_arrow = [to_arrow_type(picked.schema["doc_id"].dataType)]

    def finish(batches):
        for _, rows in _grouped(batches, 0):
            texts = [r for r in rows if r[1] == "texts"]
            (_, _, _, data, ids, learned), = texts
            b = block_of(texts_of(data), learned, order, learn=False)
            got = {(r[1], r[2]): r[3] for r in rows if r[1] != "texts"}
            del rows, texts, data
            best = np.empty(len(b.word))
            for k, x in enumerate(b.levels, 2):
                pair_n = np.zeros(len(x.pairs), dtype=np.int64)
                for s, at in pair_shards(x.contexts, b.words, x.pairs, bits):
                    pair_n[at] = unpack(got.pop((f"pair_n{k}", s)))[0]
                columns = np.zeros((6 if k == 2 else 4, len(x.contexts)), dtype=np.int64)
                for s, i, j in word_shards(x.contexts, bits):
                    columns[:, i:j] = unpack(got.pop((f"word_n{k}", s)))
                there = np.flatnonzero(x.of >= 0) if k > 2 else slice(None)
                if k == 2:
                    n_word = columns[0]
                    lower = t.lowest(columns[1])[x.pairs & 0xFFFFFFFF]
                else:               # of each n-gram, one order lower
                    lower = np.empty(len(x.pairs))
                    lower[x.of[there]] = best[there]
                p = t.higher(k, pair_n, *(c[x.pairs >> 32] for c in columns[-4:]), lower)
                best[there] = p[x.of[there]]
                del p, pair_n, lower
            score = np.log10(best, out=best)
            base, known = t.base(n_word), n_word > 0
            word = b.word
            start = np.concatenate(([0], b.ends[:-1]))
            n = b.ends - start

            def total(x):
                return np.add.reduceat(x, start)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_arrow[0]), pa.array(learned), pa.array(n),
                 pa.array(total(known[word].astype(np.int64))), pa.array(np.full(len(n), t.tokens)),
                 pa.array(total(base[word])), pa.array(total(score))],
                ["doc_id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return met.select("block", "kind", "shard", "data", "ids", "learned").mapInArrow(
        finish, f"doc_id {ids_type}, learned boolean, n_tokens bigint, n_known bigint, "
                "train_tokens bigint, base_score double, score double")
