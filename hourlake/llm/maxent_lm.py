"""Log-probability of texts under a hashed maximum-entropy model with class-factored softmax.

A token's probability is that of its class given what stands before it, times that of the word within its class given the
same. Classes are the end of a text, the most frequent words (one class each), and the other words by their endings. Both
factors are softmaxes over hashed features: the last word, the last but one (a skip feature), both together, and the last three
classes. Words of a class are told apart by a tree of softmaxes over ``FAN`` children each, whose nodes grow in number with the
vocabulary: frequent words by their frequencies (a node's children have similar shares, from which its softmax starts), all
rarer ones, which are one leaf of that tree, by further digits of their hashes until a child has about one word; words
that still share a leaf, and one place for words never seen, have their (add-one) shares of it. A node's features are hashed with
its number. All weights are trained by gradient steps that tasks take on their own documents from common
weights; after each round the tasks' weights are averaged by Spark. A round has as many such tasks as its tokens are worth, however many
partitions the documents come in, so what is sent grows with the tokens.

Counts are exact over all training documents. The most frequent words (``HEAD`` at most) and the weights, whose size is
fixed, go to every task; all rarer words are looked up shard by shard where their counts are, packed as arrays. Being rare,
none of them can be hot. Texts never cross the network.

Null and empty texts are one end token. Rows with a null id are training documents; repeated rows are counted
and scored like others. An empty table gives no rows; without training documents all counts are zero. Extra columns
are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from hourlake.llm.common import larger, longs, record, signed, text_bytes, unsigned
from hourlake.llm.rolling import U64, mix, pieces, word_hashes, words
from hourlake.sources.scratch import written

CLASSES = 32
OWN = 11  # classes 1 … OWN are single frequent words
_ENDINGS = CLASSES - OWN - 1
BUCKETS = 1 << 13  # of each kind of feature
KINDS = 4
#: Words whose counts every task holds.
HEAD = 1 << 18
KEYS_PER_SHARD = 1 << 18
#: Rare tokens of a shard that one task looks up (12 bytes each).
TOKENS_PER_TASK = 1 << 22
ROUNDS = 2
RATE = 0.3
MINIBATCH = 1 << 14
#: Tokens of a round for each task that trains (about 3 MB of text), as it sends all weights (5 MB), however few tokens it has seen.
TOKENS_PER_TRAINER = 1 << 19
#: Children of a node in a class's tree, and the binary logarithm.
FAN, DIGIT = 8, 3
#: Rows of weights of each kind of feature for the trees: grows with the vocabulary up to this.
INNER = 1 << 13
BOUND = 18.0  # of a weight, so that sums of them have exponentials
SLOT = 64  # rows of weights in one row of a DataFrame

END = U64(0)
_BEGIN = U64(0x5851F42D4C957F00)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ---------------------------------------------------------------- tokens


def tokens_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all documents, each closed by ``END``, and where each document begins (n + 1 places).

    A token is its word's hash with the class of its ending in the low five bits.
    """
    data = _LOWER[data]
    start, end, bounds = words(data, off)
    h = word_hashes(data, start, end)
    if len(end):
        ending = data[end - 1].astype(np.uint64) + U64(257) * data[np.maximum(end - 2, start)].astype(np.uint64)
        h = (h & ~U64(31)) | (U64(OWN + 1) + mix(ending) % U64(_ENDINGS))
    n = len(off) - 1
    doc = np.repeat(np.arange(n), np.diff(bounds))
    out = np.full(len(h) + n, END, dtype=np.uint64)
    out[np.arange(len(h)) + doc] = h
    return out, bounds + np.arange(n + 1)


def classes_of(tokens: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Class of each token; ``own`` are the sorted hashes of the words with a class of their own."""
    out = (tokens & U64(31)).astype(np.int64)
    if len(own):
        at = np.minimum(np.searchsorted(own, tokens), len(own) - 1)
        out = np.where(own[at] == tokens, at + 1, out)
    return out


def hashes_of(tokens: np.ndarray, classes: np.ndarray, begins: np.ndarray) -> list[np.ndarray]:
    """Hashes of the four features of each token, from the tokens before it in its document."""
    n = len(tokens)
    room = np.arange(n) - np.repeat(begins[:-1], np.diff(begins))  # tokens before, in the document

    def before(values: np.ndarray, k: int, none) -> np.ndarray:
        out = np.full(n, none, dtype=values.dtype)
        out[k:] = values[: max(0, n - k)]
        out[room < k] = none
        return out

    one, two = before(tokens, 1, _BEGIN), before(tokens, 2, _BEGIN)
    c = classes.astype(np.uint64)
    three = before(c, 1, 0) + U64(32) * before(c, 2, 0) + U64(1024) * before(c, 3, 0)
    return [mix(k) for k in (one ^ U64(0xA5A5), two ^ U64(0x3C3C), one + U64(3) * two, three ^ U64(0x77777777))]


def buckets_of(hashes: list[np.ndarray]) -> np.ndarray:
    return np.stack([(h & U64(BUCKETS - 1)).astype(np.uint16) for h in hashes])


def features_of(tokens: np.ndarray, classes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Four hashed features of each token: rows of the class weights."""
    return buckets_of(hashes_of(tokens, classes, begins))


def _powers(weights: np.ndarray, features: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the features' weights (and of ``start``), and their exponentials, which ``BOUND`` keeps finite."""
    logits = weights[0].take(features[0], axis=0)
    for k in range(1, KINDS):
        logits += weights[k].take(features[k], axis=0)
    if start is not None:
        logits += start
    return logits, np.exp(logits)


def _summed(rows: np.ndarray) -> np.ndarray:
    return rows @ np.ones(rows.shape[1], dtype=rows.dtype)


def log_softmax(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    logits, powers = _powers(weights, features)
    return logits - np.log(_summed(powers))[:, None]


def log_chosen(weights: np.ndarray, features: np.ndarray, chosen: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Log-probability of the ``chosen`` outcome in each row."""
    logits, powers = _powers(weights, features, start)
    return logits[np.arange(len(chosen)), chosen] - np.log(_summed(powers))


# ---------------------------------------------------------------- words within a class


def leaves_of(tokens: np.ndarray, classes: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """The leaf of each rare word: its class and the first ``depths`` digits of its hash (one number, by chance alone shared)."""
    digits = (mix(tokens.copy()) >> U64(1)) >> (63 - DIGIT * depths[classes]).astype(np.uint64)
    return mix(digits * U64(32) + classes.astype(np.uint64))


def _number(keys: np.ndarray) -> np.ndarray:
    return (mix(keys) >> U64(32)).astype(np.uint32)


@dataclass
class Tree:
    """Paths of frequent words, and of every class's rare words, from their class down: the nodes passed and the children taken."""

    head: np.ndarray  # sorted hashes of frequent words
    first: np.ndarray  # where the path of each begins (then of each class's rare words; one more place)
    node: np.ndarray
    child: np.ndarray
    start: np.ndarray  # of each node: logarithms of its children's shares
    number: np.ndarray  # of each node: what its features are hashed with
    depths: np.ndarray  # of each class: digits that tell its rare words apart
    rows: int  # of weights, a power of two

    @staticmethod
    def of(head: np.ndarray, counts: np.ndarray, own: np.ndarray, rare_mass: np.ndarray, rare_words: np.ndarray, vocabulary: int) -> Tree:
        """``rare_mass``: of each class, sum of (count + 1) over its words outside the head, and 1 for those never seen."""
        classes = np.concatenate([classes_of(head, own), np.arange(CLASSES)])
        mass = np.concatenate([counts + 1.0, rare_mass])
        total = len(mass)
        at = np.lexsort((-mass, classes))
        at = at[classes[at] > OWN]  # other classes are one word each
        group, nodes = classes[at], 0
        paths = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint8))]
        starts = [np.zeros((0, FAN), np.float32)]
        while len(at):
            edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            sizes = np.diff(np.append(edge, len(at)))
            keep = np.repeat(sizes > 1, sizes)
            at, group = at[keep], group[keep]
            if not len(at):
                break
            sizes = sizes[sizes > 1]
            edge = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            m = mass[at]
            node = np.repeat(np.arange(len(sizes)), sizes)
            whole = np.add.reduceat(m, edge)
            before = np.cumsum(m) - m
            before -= np.repeat(before[edge], sizes)
            # the heaviest comes first, so the last begins in the upper half: every node has two children at least
            child = np.minimum(FAN * np.maximum(before, 0.0) / whole[node], FAN - 1).astype(np.int64)
            share = np.bincount(node * FAN + child, weights=m, minlength=len(sizes) * FAN).reshape(-1, FAN)
            with np.errstate(divide="ignore"):
                starts.append(np.log(share / whole[:, None]).astype(np.float32))
            paths.append((at, (nodes + node).astype(np.int32), child.astype(np.uint8)))
            nodes += len(sizes)
            group = node * FAN + child
        rare_words = np.maximum(rare_words, 1)
        depths = np.minimum(np.ceil(np.log2(rare_words) / DIGIT), 63 // DIGIT).astype(np.int64)
        words, node, child = (np.concatenate(x) for x in zip(*paths, strict=True))
        order = np.argsort(words, kind="stable")  # levels stay in order
        first = np.concatenate([[0], np.cumsum(np.bincount(words, minlength=total))])
        rows = min(INNER, max(1 << 8, 1 << (vocabulary >> 4).bit_length()))
        return Tree(head, first, node[order], child[order], np.concatenate(starts), _number(np.arange(nodes, dtype=np.uint64) + U64(1)), depths, rows)

    def find(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each token in the head, and whether it is there."""
        if not len(self.head):
            return np.zeros(len(tokens), np.int64), np.zeros(len(tokens), dtype=bool)
        at = np.minimum(np.searchsorted(self.head, tokens), len(self.head) - 1)
        return at, self.head[at] == tokens

    def choices(self, tokens: np.ndarray, classes: np.ndarray, hashes: list[np.ndarray], at: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, ...]:
        """``token, features, start, chosen`` of every softmax that leads from a token's class to its word."""
        place = np.where(known, at, len(self.head) + classes)
        begin = self.first[place]
        n = self.first[place + 1] - begin
        token = np.repeat(np.arange(len(tokens)), n)
        j = np.arange(len(token)) + np.repeat(begin - (np.cumsum(n) - n), n)
        node, chosen = self.node[j], self.child[j]
        number = self.number.take(node)
        start = self.start.take(node, axis=0)
        rare = np.flatnonzero(~known & (classes > OWN))
        if len(rare):
            deep = self.depths[classes[rare]]
            token2 = np.repeat(rare, deep)
            level = np.arange(len(token2)) - np.repeat(np.cumsum(deep) - deep, deep)
            x = np.repeat(mix(tokens[rare]), deep)
            passed = (x >> U64(1)) >> (63 - DIGIT * level).astype(np.uint64)
            digit = ((x >> U64(1)) >> (63 - DIGIT * (level + 1)).astype(np.uint64)) & U64(FAN - 1)
            number2 = _number(passed * U64(1024) + (level * 32 + classes[token2]).astype(np.uint64) + U64(1 << 62))
            even = np.full((len(token2), FAN), -np.log(FAN), dtype=np.float32)
            token, number = np.concatenate([token, token2]), np.concatenate([number, number2])
            chosen, start = np.concatenate([chosen, digit.astype(np.uint8)]), np.concatenate([start, even])
        shift = np.uint32(32 - (self.rows.bit_length() - 1))
        short = [(h >> U64(32)).astype(np.uint32) for h in hashes]
        features = np.stack([(((h.take(token) ^ number) * np.uint32(0x9E3779B1)) >> shift).astype(np.uint16) for h in short])
        return token, features, start, chosen


def _sums_by(key: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and the sums of their rows."""
    order = np.argsort(key, kind="stable")
    key = key.take(order)
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    # two floats at a time, which numpy adds faster: as the two parts of a complex number
    sums = np.add.reduceat(rows.take(order, axis=0).view(np.complex64), at, axis=0)
    return key[at], sums.view(np.float32)


class Steps:
    """Gradient steps (each weight with its own rate) for softmaxes over hashed features."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights.copy()
        self.squares = np.full_like(weights, 1e-6)

    def learn(self, features: np.ndarray, chosen: np.ndarray, start: np.ndarray | None = None) -> None:
        if not len(chosen):
            return
        gradient = _powers(self.weights, features, start)[1]
        gradient *= (1 / _summed(gradient))[:, None]
        gradient[np.arange(len(chosen)), chosen] -= 1
        for k in range(KINDS):
            rows, sums = _sums_by(features[k], gradient)
            squares = self.squares[k].take(rows, axis=0)
            squares += sums * sums
            self.squares[k][rows] = squares
            sums *= RATE
            sums /= np.sqrt(squares, out=squares)
            weights = self.weights[k].take(rows, axis=0)
            weights -= sums
            self.weights[k][rows] = np.clip(weights, -BOUND, BOUND, out=weights)


class Trainer:
    """Steps on minibatches: of classes, and of words within their classes."""

    def __init__(self, weights: np.ndarray, inner: np.ndarray, tree: Tree):
        self.outer, self.inner, self.tree, self.seen = Steps(weights), Steps(inner), tree, 0

    def learn(self, tokens: np.ndarray, classes: np.ndarray, hashes: list[np.ndarray]) -> None:
        for i in range(0, len(tokens), MINIBATCH):
            t, c, h = tokens[i : i + MINIBATCH], classes[i : i + MINIBATCH], [x[i : i + MINIBATCH] for x in hashes]
            self.outer.learn(buckets_of(h), c)
            _, features, start, chosen = self.tree.choices(t, c, h, *self.tree.find(t))
            self.inner.learn(features, chosen, start)
            self.seen += len(c)


# ---------------------------------------------------------------- counts and training in Spark


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 7


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("h", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        data, off = text_bytes(batch)
        parts = [tokens_of(data[off[i] : off[j]], off[i : j + 1] - off[i])[0] for i, j in pieces(off)]
        if parts:
            h, n = np.unique(np.concatenate(parts), return_counts=True)
            yield record(schema, signed(h), longs(n))


_SLOTS = pa.schema([("slot", pa.int32()), ("part", pa.int32()), ("vector", pa.binary()), ("weight", pa.float64())])
_SLOTS_DDL = "slot int, part int, vector binary, weight double"


def _trained(weights: np.ndarray, inner: np.ndarray, own: np.ndarray, tree: Tree, parts: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(weights, inner, tree)
        for batch in batches:
            data, off = text_bytes(batch)
            for i, j in pieces(off):
                tokens, begins = tokens_of(data[off[i] : off[j]], off[i : j + 1] - off[i])
                classes = classes_of(tokens, own)
                trainer.learn(tokens, classes, hashes_of(tokens, classes, begins))
        if trainer.seen:
            # what has changed: rows that were not touched are zeros, which compress
            flat = np.concatenate([(new - old).reshape(-1, SLOT * CLASSES) for new, old in ((trainer.outer.weights, weights), (trainer.inner.weights, inner))])
            flat *= np.float32(trainer.seen)
            n, part = len(flat), TaskContext.get().partitionId() % parts
            yield record(_SLOTS, np.arange(n, dtype=np.int32), np.full(n, part, np.int32), pa.array([v.tobytes() for v in flat], pa.binary()), np.full(n, float(trainer.seen)))

    return rows


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the vectors of equal (slot, part); rows come sorted by these."""
    key, total, weight = None, None, 0.0
    for batch in batches:
        out = []
        for slot, part, vector, w in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (slot, part) != key:
                if key is not None:
                    out.append((*key, total.tobytes(), weight))
                key, total, weight = (slot, part), np.zeros(len(vector) // 4, dtype=np.float32), 0.0
            total += np.frombuffer(vector, dtype=np.float32)
            weight += w
        if out:
            yield record(_SLOTS, *[pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SLOTS, strict=True)])
    if key is not None:
        yield record(_SLOTS, *[pa.array([c], f.type) for c, f in zip((*key, total.tobytes(), weight), _SLOTS, strict=True)])


def _average(slots: DataFrame) -> np.ndarray | None:
    """The changes of the tasks' weights, averaged by their numbers of tokens; in two steps, so no task adds up those of all tasks."""
    for part in (F.col("part"), F.lit(0)):
        slots = slots.withColumn("part", part).repartition("slot", "part").sortWithinPartitions("slot", "part").mapInArrow(_added, _SLOTS_DDL)
    rows = sorted(slots.collect(), key=lambda r: r["slot"])  # a fixed size, whatever the corpus
    if not rows:
        return None
    return np.stack([np.frombuffer(r["vector"], dtype=np.float32) / np.float32(r["weight"]) for r in rows])


@dataclass
class Model:
    head: np.ndarray  # sorted hashes of frequent words, and their counts
    head_counts: np.ndarray
    own: np.ndarray  # sorted hashes of the words with a class of their own
    tree: Tree
    weights: np.ndarray
    inner: np.ndarray
    train_tokens: int
    vocabulary: int


def learn(texts: DataFrame, rounds: int = ROUNDS, head: int = HEAD) -> tuple[Model, DataFrame]:
    """The model, and the table ``h, n`` of the training words outside its head. ``texts`` has ``text`` (binary) only."""
    counts = texts.mapInArrow(_counted, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    counts = written(counts, "word-counts")
    total, vocabulary = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # the head: whole steps of frequency, from the top, as long as they fit
    step = F.floor(F.log2(F.col("n").cast("double")) * 32)
    sizes = sorted(((r["step"], r["words"]) for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    least, room = None, head
    for s, n in sizes:  # 64 * 32 steps at most
        room -= n
        if room < 0:
            break
        least = s
    top = counts.where(step >= least).toArrow() if least is not None else pa.table({"h": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    h, n = unsigned(top["h"].combine_chunks()), top["n"].to_numpy()
    order = np.argsort(h)
    h, n = h[order], n[order]
    words_only = np.flatnonzero(h != END)
    often = words_only[np.argsort(-n[words_only], kind="stable")][:OWN]
    own = np.sort(h[often])
    rare = counts if least is None else counts.where(step < least)
    mass, many = np.ones(CLASSES), np.zeros(CLASSES)
    for r in rare.groupBy(F.col("h").bitwiseAND(F.lit(31)).alias("c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():  # classes at most
        mass[r["c"]] += r["n"] + r["words"]
        many[r["c"]] += r["words"]
    tree = Tree.of(h, n, own, mass, many, int(vocabulary))
    weights = np.zeros((KINDS, BUCKETS, CLASSES), dtype=np.float32)
    inner = np.zeros((KINDS, tree.rows, FAN), dtype=np.float32)
    trainers = max(1, -(-int(total) // (rounds * TOKENS_PER_TRAINER)))
    parts = math.isqrt(trainers - 1) + 1  # about as many sums in the first step as tasks in each
    for k in range(rounds):
        share = texts.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == k).coalesce(trainers)
        got = _average(share.mapInArrow(_trained(weights, inner, own, tree, parts), _SLOTS_DDL))
        if got is not None:
            slots = KINDS * BUCKETS // SLOT
            weights, inner = weights + got[:slots].reshape(weights.shape), inner + got[slots:].reshape(inner.shape)
    return Model(h, n, own, tree, weights, inner, int(total), int(vocabulary)), rare


# ---------------------------------------------------------------- scoring

_PARTS = pa.schema(
    [("key", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("log_counts", pa.float64()), ("log_model", pa.float64())]
    + [("shard", pa.int64()), ("words", pa.binary()), ("keys", pa.binary())]
)
_PARTS_DDL = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, log_model double, shard long, words binary, keys binary"


def _scored(model: Model, shards: int):
    tree = model.tree
    head_logs = np.log10(model.head_counts + 1.0)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId() << 36, 0
        for batch in batches:
            data, off = text_bytes(batch)
            rare_words, rare_keys = [], []
            for i, j in pieces(off):
                tokens, begins = tokens_of(data[off[i] : off[j]], off[i : j + 1] - off[i])
                classes = classes_of(tokens, model.own)
                hashes = hashes_of(tokens, classes, begins)
                at, known = tree.find(tokens)
                counts = np.where(known, head_logs[at], 0.0) if len(model.head) else np.zeros(len(tokens))
                logs = np.empty(len(tokens))
                for a in range(0, len(tokens), MINIBATCH):
                    part = slice(a, a + MINIBATCH)
                    t, c, h = tokens[part], classes[part], [x[part] for x in hashes]
                    logs[part] = log_chosen(model.weights, buckets_of(h), c)
                    token, features, start, chosen = tree.choices(t, c, h, at[part], known[part])
                    logs[part] += np.bincount(token, weights=log_chosen(model.inner, features, chosen, start), minlength=len(t))
                logs /= np.log(10)
                keys = task + done + np.arange(j - i)
                done += j - i
                sums = lambda x: np.add.reduceat(x, begins[:-1])  # noqa: E731,B023  every document has a token
                none = pa.nulls(j - i)
                yield record(
                    _PARTS, longs(keys), batch.column("doc_id").slice(i, j - i), batch.column("held_out").slice(i, j - i), longs(np.diff(begins)),
                    longs(sums(known.astype(np.int64))), sums(counts), sums(logs), none.cast(pa.int64()), none.cast(pa.binary()), none.cast(pa.binary()),
                )
                rare = np.flatnonzero(~known)
                rare_words.append(tokens[rare])
                rare_keys.append(np.repeat(keys, np.diff(begins))[rare])
            if rare_words:
                yield from _by_shard(np.concatenate(rare_words), np.concatenate(rare_keys), shards, tree.depths)

    return lambda batches: larger(rows(batches), 2048)


def _shards_of(tokens: np.ndarray, shards: int, depths: np.ndarray) -> np.ndarray:
    """Words that share a leaf share a shard."""
    return (leaves_of(tokens, (tokens & U64(31)).astype(np.int64), depths) % U64(shards)).astype(np.int64)


def _by_shard(tokens: np.ndarray, keys: np.ndarray, shards: int, depths: np.ndarray) -> Iterator[pa.RecordBatch]:
    shard = _shards_of(tokens, shards, depths)
    order = np.argsort(shard, kind="stable")
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(edges)):
        at = order[edges[s] : edges[s + 1]]
        empty = [pa.nulls(1).cast(f.type) for f in list(_PARTS)[:7]]
        empty[3] = longs([len(at)])
        low = int(keys[at].min())
        packed = np.int64(low).tobytes() + (keys[at] - low).astype("<u4").tobytes()
        yield record(_PARTS, *empty, longs([s]), pa.array([tokens[at].tobytes()], pa.binary()), pa.array([packed], pa.binary()))


_FOUND = pa.schema([("key", pa.int64()), ("known", pa.int64()), ("logs", pa.float64()), ("shares", pa.float64())])


def _looked_up(depths: np.ndarray):
    def leaves(h: np.ndarray) -> np.ndarray:
        return leaves_of(h, (h & U64(31)).astype(np.int64), depths)

    def looked_up(left: pa.Table, right: pa.Table) -> pa.Table:
        """Of one shard's rare tokens: counts, and shares of their leaves, summed by document."""
        if not right.num_rows:
            return _FOUND.empty_table()  # words never seen, alone in their leaves
        h, n = unsigned(right["h"].combine_chunks()), right["n"].to_numpy()
        order = np.argsort(h)
        h, n = h[order], n[order]
        logs = np.log10(n + 1.0)
        leaf, place = np.unique(leaves(h), return_inverse=True)
        mass = np.log10(np.bincount(place, weights=n + 1.0, minlength=len(leaf)) + 1.0)  # and 1 for words never seen
        out = []
        for tokens, keys in zip(left["words"].to_pylist(), left["keys"].to_pylist(), strict=True):
            tokens, low, offset = np.frombuffer(tokens, np.uint64), np.frombuffer(keys[:8], np.int64)[0], np.frombuffer(keys[8:], "<u4").astype(np.int64)
            at = np.minimum(np.searchsorted(h, tokens), len(h) - 1)
            hit = h[at] == tokens
            asked = leaves(tokens)
            there = np.minimum(np.searchsorted(leaf, asked), len(leaf) - 1)
            counted = np.where(hit, logs[at], 0.0)
            share = counted - np.where(leaf[there] == asked, mass[there], 0.0)
            found, place = np.unique(offset, return_inverse=True)
            out.append((found + low, *[np.bincount(place, weights=x, minlength=len(found)) for x in (hit, counted, share)]))
        if not out:
            return _FOUND.empty_table()
        keys, known, sums, shares = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table([longs(keys), longs(known), pa.array(sums, pa.float64()), pa.array(shares, pa.float64())], schema=_FOUND)

    return looked_up


def lm_scores(docs: DataFrame, rounds: int = ROUNDS, head: int = HEAD) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    Held out (never learned from): crc32 of the id's text modulo 7 is 2.
    """
    held = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("binary").alias("text"))
    model, rare_counts = learn(rows.where(~F.col("held_out")).select("text"), rounds, head)
    shards = max(1, -(-model.vocabulary // KEYS_PER_SHARD))
    parts = written(rows.mapInArrow(_scored(model, shards), _PARTS_DDL), "scores")
    rare = parts.where("shard is not null")
    # a shard that very many tokens ask is copied, and each copy answers a part of them
    copies = written(rare.groupBy("shard").agg(F.ceil(F.sum("n_tokens") / TOKENS_PER_TASK).cast("int").alias("copies")), "copies")
    rare = rare.join(copies, "shard").select("shard", F.pmod(F.xxhash64("keys"), F.col("copies")).cast("int").alias("copy"), "words", "keys")
    mixed = _with_shard(rare_counts, shards, model.tree.depths).join(copies, "shard").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    mixed = written(mixed.select("shard", "copy", "h", "n"), "count-shards")
    by = ("shard", "copy")
    found = rare.groupBy(*by).cogroup(mixed.groupBy(*by)).applyInArrow(_looked_up(model.tree.depths), "key long, known long, logs double, shares double")
    found = found.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("known", "logs", "shares")])
    scored = parts.where("shard is null").drop("shard", "words", "keys").join(found, "key", "left").na.fill({"known": 0, "logs": 0.0, "shares": 0.0})
    base = float(np.log10(model.train_tokens + model.vocabulary + 1.0))
    return scored.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("known")).alias("n_known"), F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + F.col("logs") - F.col("n_tokens") * F.lit(base)).alias("base_score"), (F.col("log_model") + F.col("shares")).alias("score"),
    )


def _with_shard(counts: DataFrame, shards: int, depths: np.ndarray) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = _shards_of(unsigned(batch.column(0)), shards, depths)
            yield pa.RecordBatch.from_arrays([longs(shard), batch.column(0), batch.column(1)], names=["shard", "h", "n"])

    return counts.select("h", "n").mapInArrow(rows, "shard long, h long, n long")
