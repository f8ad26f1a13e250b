"""Language-model scoring with a log-bilinear model trained by noise contrast.

The next word's vector is predicted from the two words before it by two
matrices, q = R[w1] C1 + R[w2] C2. A word's probability is that of its class,
the softmax of q . U[class] + a[class], times that of the word within its class,
the softmax of q . Q[w] + b[w] there; both are exact. Classes are stretches of
words in order of count with equal sums of sqrt(p), as many as that sum, which makes
the products of a token fewest, 2 sqrt(V) at most.
Training is in numpy: word scores by noise contrast, with one set of noise words
per minibatch, class scores by their softmax. A worker counts the different
(two words, next word) of its share of the positions and takes minibatches over these,
weighted by their counts; one that comes often is split, so that it weighs ``OFTEN`` at
most at a time. After each round the workers' parameters are averaged,
weighted by positions. Every position of every training document is an example, in
one of the ``ROUNDS``: a round takes every ROUNDS-th position of a document, from a
start hashed from its id, and the next round starts one further.

Texts are encoded once, into word numbers that training and scoring both read.

The vocabulary grows with the corpus: it is every word that is seen at least
``least_count`` times, max(LEAST, sqrt(N) / ROOT) in N training tokens, without a
limit on their number (there can't be more than ROOT sqrt(N)). The rarer words share
one place in it; their own probability within that place is by add-one counts over
all training documents, so a text's probability is a proper one. All words are
counted. The model's words, and the most frequent up to HEAD where those are more,
are sent to every worker; the others' counts are joined by shuffle. Words are counted and
looked up in Arrow, and a text's numbers are stored as bytes, not as an array.

A document is held out if crc32 of its doc_id as text is 2 modulo 7.

Defined results: null is the empty text, one end token; a null doc_id counts as
the text ''; rows that share doc_id and text are scored alike, and each counts
in training; without training documents N and V are 0 and every base score is
0; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_of
from .hashing import batches_of, mix

FOLDS, HELD = 7, 2
#: A word of the model is seen LEAST times and sqrt(tokens) / ROOT times at least.
LEAST, ROOT = 5, 50
#: Words whose counts every worker holds (about 20 bytes each), if the model's words aren't more.
HEAD = 100_000
DIM, NOISE, BATCH, ROUNDS, OFTEN = 24, 64, 250, 2, 16
#: Tokens scored at a time, and the numbers of a product of theirs that is held at once (a megabyte, which stays in a core's cache).
SCORED, CELLS = 500_000, 262_144
#: Positions dealt to a worker, if the model's parameters aren't more; numbers of a model that are averaged in one row.
SHARE, BLOCK = 2_000_000, 65_536
END = b""


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the words of all texts in UTF-8, in A-Z lower case, in a row; how many each text has), without the ends."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words = lists.flatten().view(pa.binary())
    full = pc.greater(pc.binary_length(words), 0)  # there are empty ones beside the spaces around a text
    before = np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))
    return words.filter(full), np.diff(before[np.append(0, np.cumsum(lists.value_lengths().to_numpy()))])


def pieces(texts: pa.Array, size: int = 4_000_000):
    """(lo, hi) of the texts to split at a time, of ``size`` bytes or one text."""
    return batches_of(pc.binary_length(texts).to_pylist(), size)


def utf8() -> Column:
    return text_of().cast("binary").alias("text")


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == HELD


def least_count(total: int) -> int:
    return max(LEAST, math.isqrt(total) // ROOT)


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


@dataclass
class Model:
    """Ids: 0 the end, 1 .. words in order of count, then one for all other words, then the begin (context only)."""

    r: np.ndarray
    q: np.ndarray
    c: np.ndarray
    b: np.ndarray
    u: np.ndarray
    a: np.ndarray
    starts: np.ndarray  # first word of each class

    @classmethod
    def fresh(cls, counts: np.ndarray, dim: int = DIM, seed: int = 1) -> Model:
        rng = np.random.default_rng(seed)
        n = len(counts)
        p = (counts + 0.5) / (counts + 0.5).sum()
        root = np.cumsum(np.sqrt(p)) - np.sqrt(p) / 2
        starts = np.unique(np.floor(root / np.sqrt(p).sum() * np.ceil(np.sqrt(p).sum())), return_index=True)[1]
        mass = np.add.reduceat(p, starts)
        turn = np.stack([np.eye(dim), 0.5 * np.eye(dim)])
        parts = rng.normal(0, 0.3, (n + 1, dim)), rng.normal(0, 0.01, (n, dim)), turn, np.log(p), rng.normal(0, 0.01, (len(mass), dim)), np.log(mass)
        return cls(*[x.astype(np.float32) for x in parts], starts)

    def groups(self) -> np.ndarray:
        """Class of every word."""
        return np.repeat(np.arange(len(self.a)), np.diff(np.append(self.starts, len(self.b))))

    def parts(self) -> list[np.ndarray]:
        return [self.r, self.q, self.c, self.b, self.u, self.a]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()])

    def like(self, flat: np.ndarray) -> Model:
        out, at = [], 0
        for x in self.parts():
            out.append(flat[at : at + x.size].reshape(x.shape))
            at += x.size
        return Model(*out, self.starts)

    def state(self, w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
        return self.r[w1] @ self.c[0] + self.r[w2] @ self.c[1]

    def log_probs(self, w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
        """(contexts, vocabulary) normalised natural log-probabilities."""
        q = self.state(w1, w2)
        group = log_softmax(q @ self.u.T + self.a)
        each = zip(np.split(self.q, self.starts[1:]), np.split(self.b, self.starts[1:]), strict=True)
        within = [log_softmax(q @ x.T + b) for x, b in each]
        return np.concatenate([x + group[:, [k]] for k, x in enumerate(within)], 1)

    def log_prob(self, w1: np.ndarray, w2: np.ndarray, w: np.ndarray, rows: int | None = None) -> np.ndarray:
        """Of one word after each context: its class, and it among the words of its class; products of CELLS numbers or of ``rows`` contexts at a time.

        A context that stands several times in a row has the sum over its classes taken once.
        """
        new = np.append(True, (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1]))[: len(w)]
        which = np.cumsum(new) - 1
        q = (self.r @ self.c[0])[w1[new]]
        q += (self.r @ self.c[1])[w2[new]]
        blocks = lambda lo, hi, size: ((i, min(i + size, hi)) for i in range(lo, hi, size))

        def log_sum(z):
            top = z.max(0)
            z -= top
            return top + np.log(np.exp(z, out=z).sum(0))

        every, out, groups = np.empty(len(q), np.float32), np.empty(len(w)), self.groups()
        for i, j in blocks(0, len(q), rows or max(16, CELLS // len(self.a))):
            every[i:j] = log_sum(self.u @ q[i:j].T + self.a[:, None])
        # by class, and within one by context: words of a class after the same context share its sum
        order = np.argsort(groups[w].astype(np.uint16) if len(self.a) <= 1 << 16 else groups[w], kind="stable")
        cuts = np.append(0, np.cumsum(np.bincount(groups[w], minlength=len(self.a))))
        for k in np.flatnonzero(np.diff(cuts)):
            own = slice(self.starts[k], self.starts[k + 1] if k + 1 < len(self.a) else len(self.b))
            x, bias = self.q[own], self.b[own][:, None]
            for i, j in blocks(cuts[k], cuts[k + 1], rows or max(16, CELLS // len(bias))):
                at = order[i:j]
                after = which[at]
                first = np.append(True, after[1:] != after[:-1])
                same, after = np.cumsum(first) - 1, after[first]
                mine = q.take(after, 0)
                got = mine @ self.u[k] + self.a[k] - every[after]
                if len(bias) > 1:
                    z = x @ mine.T
                    z += bias
                    hit = z[w[at] - self.starts[k], same]
                    got = (got - log_sum(z))[same] + hit
                else:
                    got = got[same]
                out[at] = got
        return out


def climb(table: np.ndarray, had: np.ndarray, rows: np.ndarray, values: np.ndarray, rate: float) -> None:
    """Adagrad's step on the rows of ``table`` that occur, the values of a repeated one summed.

    A row holds numbers and, as many again, their sums of squares; ``had`` are the rows as read
    for this minibatch, so that the table, which no cache holds, is read once and written once.
    """
    order = np.argsort(rows.astype(np.uint16) if len(table) <= 1 << 16 else rows, kind="stable")  # short numbers sort by digits
    rows = rows[order]
    edge = np.ones(len(rows) + 1, bool)
    np.not_equal(rows[1:], rows[:-1], out=edge[1:-1])
    starts = edge.nonzero()[0]
    counts, starts = starts[1:] - starts[:-1], starts[:-1]
    first, rows = order[starts], rows[starts]
    g, new = values.take(first, 0), had.take(first, 0)
    many = (counts > 1).nonzero()[0]
    if len(many):  # most rows come once and need no sum
        again = order[~(edge[:-1] & edge[1:])]
        g[many] = np.add.reduceat(values.take(again, 0), np.cumsum(counts[many]) - counts[many], axis=0)
    n = g.shape[1]
    new[:, n:] += g * g
    g /= np.sqrt(new[:, n:])
    g *= rate
    new[:, :n] += g
    table[rows] = new


def distinct(w1: np.ndarray, w2: np.ndarray, w: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(w1, w2, w, at): the different examples of a vocabulary of n and where each of the given is among them."""
    key = (w1.astype(np.int64) * n + w2) * n + w
    bits = max(1, len(key) - 1).bit_length()
    if n**3 << bits <= 1 << 63:  # the place in the low bits: sorting numbers is faster than sorting places by them
        packed = np.sort(key << bits | np.arange(len(key)))
        order, key = packed & ((1 << bits) - 1), packed >> bits
        new = np.append(True, key[1:] != key[:-1])[: len(key)]
        at = np.empty(len(key), np.int64)
        at[order] = np.cumsum(new) - 1
        one = order[new]
        return w1[one], w2[one], w[one], at
    key, at = np.unique(key, return_inverse=True)
    return key // (n * n), key // n % n, key % n, at


def weighted(w1: np.ndarray, w2: np.ndarray, w: np.ndarray, n: int, often: int = OFTEN) -> tuple[np.ndarray, ...]:
    """(w1, w2, w, weight): the different examples with their counts, in parts of ``often`` at most."""
    key = w1.astype(np.int64)
    for x in (w2, w):
        key *= n
        key += x
    key, count = np.unique(key, return_counts=True)
    parts = -(-count // often)
    again = np.repeat(np.arange(len(count)), parts)
    weight, key = (count / parts).astype(np.float32)[again], key[again]
    return (key // (n * n)).astype(np.int32), (key // n % n).astype(np.int32), (key % n).astype(np.int32), weight


def train_share(model: Model, w1, w2, w, weight, noise_p: np.ndarray, rate: float, seed: int, batch: int = BATCH, k: int = NOISE) -> Model:
    """One pass of minibatches (Adagrad) over weighted examples: noise contrast for words, softmax for classes.

    Biases are the last column of their vectors here, the two matrices are one above the other, and a word's sums of
    squares stand beside its numbers.
    """
    rng = np.random.default_rng(seed)
    dim = model.r.shape[1]
    c, ua = model.c.reshape(2 * dim, dim).copy(), np.column_stack([model.u, model.a])
    sc, su = [np.full(x.shape, 1e-6, np.float32) for x in (c, ua)]
    beside = lambda x: np.concatenate([x, np.full(x.shape, 1e-6, np.float32)], 1)
    r, qb = beside(model.r), beside(np.column_stack([model.q, model.b]))
    order = rng.permutation(len(w))
    before, w, weight = np.stack([w1[order], w2[order]], 1), w[order], weight[order]
    log_k = np.log(k * noise_p).astype(np.float32)
    cum = np.cumsum(noise_p)
    group = model.groups()[w]
    drawn = np.minimum(np.searchsorted(cum, rng.random((-(-len(w) // batch), k))), len(cum) - 1).astype(w.dtype)
    for i, noise in zip(range(0, len(w), batch), drawn, strict=True):
        at = slice(i, i + batch)
        y, n = w[at], weight[at] / weight[at].sum()
        words = np.concatenate([y, noise])
        rows = before[at].ravel()
        had, had_words, lw = r.take(rows, 0), qb.take(words, 0), log_k[words]
        seen = had[:, :dim].reshape(len(y), 2 * dim)
        qy, qn = had_words[: len(y), : dim + 1], had_words[len(y) :, : dim + 1]
        q = np.ones((len(y), dim + 1), np.float32)
        np.matmul(seen, c, out=q[:, :dim])
        true = np.einsum("ij,ij->i", q, qy) - lw[: len(y)]
        up = (n / (1 + np.exp(np.minimum(true, 30))))[:, None]  # pull on the true words
        down = q @ qn.T  # push on the noise
        down -= lw[len(y) :]
        np.maximum(down, -30, out=down)
        np.exp(np.negative(down, out=down), out=down)
        down += 1
        np.divide(-n[:, None], down, out=down)
        z = ua @ q.T
        z -= z.max(0)
        np.exp(z, out=z)
        z *= -n / z.sum(0)
        z[group[at], np.arange(len(y))] += n
        gq = down @ qn
        gq += z.T @ ua
        gq += up * qy
        gq = gq[:, :dim]
        gc, gu = seen.T @ gq, z @ q
        climb(r, had, rows, (gq @ c.T).reshape(len(rows), dim), rate)
        climb(qb, had_words, words, np.concatenate([up * q, down.T @ q]), rate)
        for x, g, s in ((c, gc, sc), (ua, gu, su)):
            s += g * g
            x += rate * g / np.sqrt(s)
    cut = lambda x: (np.ascontiguousarray(x[:, :dim]), x[:, dim].copy())
    return Model(r[:, :dim].copy(), cut(qb)[0], c.reshape(2, dim, dim), cut(qb)[1], *cut(ua), model.starts)


@dataclass
class Lexicon:
    """Bounded: the HEAD most frequent words with their counts, and the totals over all training words."""

    index: dict[bytes, int]
    counts: np.ndarray
    total: int
    distinct: int
    vocab: int  # ids below are the model's own words

    @property
    def other(self) -> int:
        return self.vocab

    @property
    def begin(self) -> int:
        return self.vocab + 1

    def other_mass(self) -> tuple[int, int]:
        """Tokens and kinds outside the model's words."""
        return self.total - int(self.counts[: self.vocab].sum()), self.distinct - self.vocab

    def unigrams(self) -> np.ndarray:
        return np.append(self.counts[: self.vocab], self.other_mass()[0]).astype(float)


def own(ids: np.ndarray, vocab: int) -> np.ndarray:
    """The model's ids of head indexes."""
    return np.where((ids < 0) | (ids >= vocab), ids.dtype.type(vocab), ids)


def summed(counts: list[pa.StructArray]) -> list[pa.RecordBatch]:
    """(token, c) of several pieces' words and counts."""
    parts = [pa.chunked_array([x.field(i) for x in counts], t) for i, t in enumerate((pa.binary(), pa.int64()))]
    table = pa.Table.from_arrays(parts, ["token", "n"]).group_by("token", use_threads=False).aggregate([("n", "sum")])
    return table.select(["token", "n_sum"]).rename_columns(["token", "c"]).to_batches()


def word_counts(docs: DataFrame, flush: int = 1_000_000) -> DataFrame:
    """(token, c) over all training documents, the end included; partial counts leave a worker when its pieces of texts have ``flush`` words in all."""

    def run(batches):
        counts, held, ends = [], 0, 0
        for b in batches:
            texts = b.column("text")
            for lo, hi in pieces(texts):
                counts.append(pc.value_counts(split_words(texts.slice(lo, hi - lo))[0]))
                held, ends = held + len(counts[-1]), ends + hi - lo
                if held >= flush:
                    yield from summed(counts)
                    counts, held = [], 0
        yield from summed(counts)
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([ends], pa.int64())], ["token", "c"])

    some = docs.where(~held_out()).select(utf8()).mapInArrow(run, "token binary, c long")
    return some.groupBy("token").agg(F.sum("c").alias("c"))


def lexicon(counts: DataFrame, least: int | None = None, head: int = HEAD) -> Lexicon:
    """The model's words are those seen ``least`` times."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    least = least_count(total.n) if least is None else least
    words = counts.where(F.octet_length("token") > 0)
    # steps of a sixteenth of an octave: some hundred rows, however many kinds of words there are
    step = F.floor(F.log2("c") * 16)
    kinds, cut = 0, None
    for r in sorted(words.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r.step):
        if (kinds := kinds + r.n) > head:
            break
        cut = r.step
    few = words.where((F.col("c") >= least) if cut is None else (F.col("c") >= least) | (step >= cut))
    top = few.toPandas()
    top["token"] = top["token"].map(bytes)
    top = top.sort_values(["c", "token"], ascending=[False, True], ignore_index=True)
    end = counts.where(F.octet_length("token") == 0).select("c").first()
    held = [END, *top["token"]] if end else []
    own = int((top["c"] >= least).sum()) + 1 if end else 0
    return Lexicon({w: i for i, w in enumerate(held)}, np.array([end[0], *top["c"]], np.int64) if end else np.zeros(0, np.int64), total.n, total.v, own)


def encode(head: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(index in ``head``, whose first is the end, or -1 of every token; tokens in each text; the words that aren't in the head; how many each text has of these)."""
    words, n = split_words(texts)
    w = pc.fill_null(pc.index_in(words, value_set=head), -1).to_numpy()
    ids = np.full(len(w) + len(n), 0 if len(head) else -1, np.int32)
    word = np.ones(len(ids), bool)
    word[np.cumsum(n + 1) - 1] = False
    ids[word] = w
    rare = np.append(0, np.cumsum(w < 0))
    return ids, n + 1, words.filter(pa.array(w < 0)), np.diff(rare[np.append(0, np.cumsum(n))])


def contexts(w: np.ndarray, sizes: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """(word before, word before that) of every place in texts of so many words."""
    start = np.cumsum(sizes) - sizes
    w1, w2 = np.full_like(w, begin), np.full_like(w, begin)
    w1[1:] = w[:-1]
    w1[start] = begin
    w2[1:] = w1[:-1]
    w2[start] = begin
    return w1, w2


def encoded(docs: DataFrame, lex: Lexicon) -> DataFrame:
    """(doc_id, held_out, h, ids, rare): a number of the row, head indexes of its tokens (-1 for words that aren't in the head) as bytes, and those words.

    The row's number holds once the result is stored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(list(lex.index))

    def places(sizes):
        return pa.array(np.append(0, np.cumsum(sizes)), pa.int32())

    def run(batches):
        head = pa.array(shared.value, pa.binary())
        for b in batches:
            texts = b.column("text")
            for lo, hi in pieces(texts):
                ids, sizes, rare, some = encode(head, texts.slice(lo, hi - lo))
                same = [b.column(x).slice(lo, hi - lo) for x in ("doc_id", "held_out", "h")]
                numbers = pa.Array.from_buffers(pa.binary(), len(sizes), [None, places(4 * sizes).buffers()[1], pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([*same, numbers, pa.ListArray.from_arrays(places(some), rare)], ["doc_id", "held_out", "h", "ids", "rare"])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.monotonically_increasing_id().alias("h"), utf8())
    return base.mapInArrow(run, "doc_id long, held_out boolean, h long, ids binary, rare array<binary>")


def chosen(d: np.ndarray, sizes: np.ndarray, i: int, rounds: int = ROUNDS) -> np.ndarray:
    """The places of round i: every rounds-th of each document, so that the rounds share all of them."""
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    first = (mix(d.astype(np.int64).view(np.uint64)) % np.uint64(rounds)).astype(np.int64)
    return np.flatnonzero((place + i) % rounds == np.repeat(first, sizes))


def fit(texts: DataFrame, lex: Lexicon, rounds: int = ROUNDS, share: int = SHARE, rate: float = 0.1) -> Model:
    """Rounds of local training and averaging over encoded texts."""
    spark = texts.sparkSession
    noise = lex.unigrams()
    noise = (noise + 0.5) / (noise + 0.5).sum()
    model = Model.fresh(lex.unigrams())
    if not lex.total:
        return model
    # the models sent to be averaged are not more than the positions
    workers = -(-lex.total // max(share, len(model.flat())))
    mine = texts.where("not held_out").select(F.coalesce("doc_id", F.lit(0)).alias("d"), "ids")
    dealt = mine.withColumn("worker", F.pmod(F.xxhash64("d"), F.lit(workers)).cast("int"))
    vocab = lex.vocab
    for i in range(rounds):
        state = spark.sparkContext.broadcast((model, noise))

        def run(batches, state=state, i=i):
            m, p = state.value

            def train(k, d, rows):
                sizes, w = np.array([len(r) for r in rows]) // 4, own(np.frombuffer(b"".join(rows), np.int32), vocab)
                w1, w2 = contexts(w, sizes, len(m.b))
                use = chosen(np.array(d), sizes, i, rounds)
                n = len(use)
                if not n:
                    return
                some = weighted(w1[use], w2[use], w[use], len(m.b) + 1)
                del w, w1, w2, use
                flat = train_share(m, *some, p, rate / (1 + i), 1000 * i + k).flat()
                for at in range(0, len(flat), BLOCK):
                    yield pd.DataFrame({"block": [at // BLOCK], "x": [flat[at : at + BLOCK].tobytes()], "n": [n]})

            worker, ds, ws = None, [], []
            for b in batches:
                for k, d, w in b[["worker", "d", "ids"]].itertuples(index=False, name=None):
                    if k != worker and ws:
                        yield from train(worker, ds, ws)
                        ds, ws = [], []
                    worker = k
                    ds.append(d)
                    ws.append(w)
            if ws:
                yield from train(worker, ds, ws)

        def mean(batches):
            block, total, n = None, None, 0
            for b in batches:
                for k, x, m in b[["block", "x", "n"]].itertuples(index=False, name=None):
                    if k != block:
                        if n:
                            yield pd.DataFrame({"block": [block], "x": [(total / n).astype(np.float32).tobytes()]})
                        block, total, n = k, 0.0, 0
                    total, n = total + m * np.frombuffer(x, np.float32).astype(float), n + m
            if n:
                yield pd.DataFrame({"block": [block], "x": [(total / n).astype(np.float32).tobytes()]})

        per = dealt.repartition(workers, "worker").sortWithinPartitions("worker", "d").mapInPandas(run, "block int, x binary, n long")
        means = per.repartition("block").sortWithinPartitions("block").mapInPandas(mean, "block int, x binary")
        rows = materialize(means, "averages").toPandas().sort_values("block")
        if len(rows):
            model = model.like(np.frombuffer(b"".join(map(bytes, rows["x"])), np.float32))
    return model


def scored(rows: list[np.ndarray], counts: np.ndarray, vocab: int, model: Model) -> pd.DataFrame:
    """n_tokens, n_known, known (sum of log10(c + 1) in the head), own (that of words outside the model), lm (log10 by the model), n_other."""
    out, at = [], 0
    logs = np.append(np.log10(counts + 1.0), 0.0)
    while at < len(rows):
        end, total = at, 0
        while end < len(rows) and (not total or total + len(rows[end]) <= SCORED):
            total, end = total + len(rows[end]), end + 1
        sizes, ids = np.array([len(r) for r in rows[at:end]]), np.concatenate(rows[at:end])
        owner = np.repeat(np.arange(end - at), sizes)
        w = own(ids, vocab)
        *different, where = distinct(*contexts(w, sizes, vocab + 1), w, vocab + 2)
        got = model.log_prob(*different)[where]
        other = w == vocab
        sums = lambda x: np.bincount(owner, x, end - at)  # noqa: B023, E731
        out.append(pd.DataFrame({
            "n_tokens": sizes, "n_known": sums((ids >= 0).astype(float)).astype(np.int64), "known": sums(logs[ids]),
            "own": sums(np.where(other, logs[ids], 0.0)), "lm": sums(got) / np.log(10), "n_other": sums(other.astype(float)).astype(np.int64),
        }))
        at = end
    return pd.concat(out, ignore_index=True)


def score(docs: DataFrame, least: int | None = None, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    counts = materialize(word_counts(docs), "counts")
    lex = lexicon(counts, least, head)
    texts = materialize(encoded(docs, lex), "encoded")
    model = fit(texts, lex)
    state = docs.sparkSession.sparkContext.broadcast((lex.counts, lex.vocab, model))

    def run(batches):
        for b in batches:
            if len(b):
                yield pd.concat([b[["doc_id", "held_out", "h"]].reset_index(drop=True), scored([np.frombuffer(x, np.int32) for x in b["ids"]], *state.value)], axis=1)

    schema = "doc_id long, held_out boolean, h long, n_tokens long, n_known long, known double, own double, lm double, n_other long"
    rows = materialize(texts.select("doc_id", "held_out", "h", "ids").mapInPandas(run, schema), "scored")
    # the counts of rare words, joined to the rows that have them; the counts, one of each word, are looked up, so that no side is sorted
    rare = texts.where(F.size("rare") > 0).select("h", F.explode("rare").alias("token"))
    per = rare.join(counts.hint("shuffle_hash"), "token").groupBy("h").agg(F.sum(F.log10(F.col("c") + 1)).alias("more"), F.count("*").alias("seen"))
    out = rows.join(materialize(per, "rare"), "h", "left")
    more, seen = F.coalesce("more", F.lit(0.0)), F.coalesce("seen", F.lit(0))
    n_own, v_own = lex.other_mass()
    base_log = float(np.log10(lex.total + lex.distinct + 1))
    own_log = float(np.log10(n_own + v_own + 1))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + seen).cast("long").alias("n_known"),
        F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("known") + more - F.col("n_tokens") * base_log).alias("base_score"),
        (F.col("lm") + F.col("own") + more - F.col("n_other") * own_log).alias("score"),
    )


def op3_lm(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
