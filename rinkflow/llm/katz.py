"""Katz backoff bigrams over a corpus: Good-Turing discounts, exactly normalised backoff weights.

Tokens are words (see ``words``; 64-bit hashes stand for them), then one end per
document; a document's first token has the context "start". With c() the counts
over the training documents, N all training tokens and d(r) Katz's discount of
Good-Turing counts up to K:

- P(w) = d(c(w)) * c(w) / N; what is left goes to "unknown", all unseen words.
- P(w | v) = d'(c(v w)) * c(v w) / c(v) if c(v w) > 0, else a(v) * P(w), where
  a(v) = (1 - sum of P(x | v)) / (1 - sum of P(x)), both over the x seen after v.
  Where no count after v is discounted, c(v) is taken larger by one, which
  leaves the unseen a share. An unseen v leaves P(w).

The corpus is cut into blocks of documents. A block keeps its tokens as places
in its list of distinct words, and asks for the counts of its distinct words
and bigrams only, each a request to one partition of the model by hash:

1. blocks -> word partitions: training counts add up to the word table; the
   replies give every block the counts and numbers of its words.
2. blocks -> bigram partitions (by context; a context with a thousandth of all
   tokens is spread by its follower too): training counts add up to the bigram
   table, with what a(v) needs for every context; replies go to the blocks.
3. blocks score their documents.

All arrays travel packed (differences, byte planes, compressed), so a bigram
of a block takes a few bytes; the model's tables have a row per partition.
"""

import gc

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F

from rinkflow.llm import words as W
from rinkflow.llm.workers import ship
from rinkflow.session import materialize

#: Counts up to K are discounted.
K = 5
#: Tokens in a block: what a task holds at once (one longer document may exceed it).
BLOCK_TOKENS = 1_200_000
#: A context with more than one in so many training tokens is spread over the partitions.
SPREAD = 1_000
END = np.uint64(0x9D1F3C5B7A2E4680)
#: The number of the context "start"; words count from 1.
START = 0

_ROW = (
    "block long, kind string, part long, docs array<long>, held array<boolean>, sizes array<int>,"
    " a binary, b binary, c binary, d binary, stat array<double>"
)
_KINDS = [
    ("block", pa.int64()), ("kind", pa.string()), ("part", pa.int64()), ("docs", pa.list_(pa.int64())),
    ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())), ("a", pa.binary()), ("b", pa.binary()),
    ("c", pa.binary()), ("d", pa.binary()), ("stat", pa.list_(pa.float64())),
]


def pack(values):
    """Whole or floating numbers of 64 bits as compressed byte planes."""
    values = np.ascontiguousarray(values).view(np.uint64)
    planes = values.view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data, dtype=np.uint64):
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def pack_sorted(values):
    values = np.asarray(values, np.uint64)
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data):
    with np.errstate(over="ignore"):
        return np.cumsum(unpack(data), dtype=np.uint64)


def _rows(rows):
    arrays = [pa.array([r.get(name) for r in rows], kind) for name, kind in _KINDS]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in _KINDS])


def _table(rows):
    return pa.Table.from_batches([_rows(rows)])


# --- discounts


def discounts(n):
    """d(0) to d(K) from n[r], the number of items that occur r times (r up to K + 1).

    Good-Turing's where they lie between 0 and 1 for every r; else absolute
    discounts by (n1 + 1) / (n1 + 2 n2 + 2), which always do.
    """
    n = np.asarray(n, float)
    d = np.ones(K + 1)
    if np.all(n[1:] > 0):
        tail = (K + 1) * n[K + 1] / n[1]
        r = np.arange(1, K + 1)
        if tail < 1:
            d[1:] = ((r + 1) * n[2:] / (r * n[1:-1]) - tail) / (1 - tail)
            if np.all((d[1:] > 0) & (d[1:] < 1)):
                return d
    d[1:] = 1 - (n[1] + 1) / (n[1] + 2 * n[2] + 2) / np.arange(1, K + 1)
    return d


class Words:
    """What the driver knows of the words: totals and discounts."""

    def __init__(self, n, total, distinct, starts):
        self.total, self.distinct, self.starts = total, distinct, starts
        self.d = discounts(n)
        seen = sum((self.d[r] * r * n[r] for r in range(1, K + 1)), 0.0)
        small = sum(r * n[r] for r in range(1, K + 1))
        self.unknown = (total - seen - (total - small)) / total if total else 1.0

    def probability(self, counts):
        """P(w) by the training count of w; the unknown words' where it is 0."""
        counts = np.asarray(counts, float)
        d = np.where(counts <= K, self.d[np.minimum(counts, K).astype(int)], 1.0)
        return np.where(counts > 0, d * counts / max(self.total, 1), self.unknown)


# --- blocks


def _blocks(docs):
    """A row of kind "block" for every block of documents: doc_id, text, held_out."""

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        held, size = [], 0
        for batch in batches:
            for a, b in W.chunks(batch.column(1)):
                hashes, offsets = W.word_hashes(batch.column(1).slice(a, b - a))
                ids, flags = (batch.column(i).slice(a, b - a).to_pylist() for i in (0, 2))
                held.append((ids, flags, hashes, offsets))
                size += len(hashes) + len(ids)
                if size >= BLOCK_TOKENS:
                    yield _rows([_block(held, part << 32 | number)])
                    held, size, number = [], 0, number + 1
        if held:
            yield _rows([_block(held, part << 32 | number)])

    return docs.mapInArrow(run, _ROW)


def _block(parts, block):
    """Tokens as ranks among the block's distinct words, which are in order of their hashes.

    A word's rank goes by its occurrences, so that ranks pack well; it follows from ``b``.
    """
    ids, flags, tokens, sizes = [], [], [], []
    for i, f, hashes, offsets in parts:
        ids += i
        flags += f
        n = np.diff(offsets)
        sizes.append(n + 1)
        tokens.append(np.insert(hashes, offsets[1:], END))
    tokens, sizes = np.concatenate(tokens), np.concatenate(sizes)
    train = np.repeat(~np.array(flags, bool), sizes)
    words, place = np.unique(tokens, return_inverse=True)
    counts = np.bincount(place, minlength=len(words))
    ranks = np.empty(len(words), np.int64)
    ranks[np.argsort(-counts, kind="stable")] = np.arange(len(words))
    return {
        "block": block, "kind": "block", "docs": ids, "held": flags, "sizes": sizes,
        "a": pack_sorted(words), "b": pack(counts), "c": pack(np.bincount(place[train], minlength=len(words))),
        "d": pack(ranks[place]),
    }


def _slices(keys, parts):
    """Bounds of ``parts`` equal ranges of 64-bit hashes in sorted keys."""
    edges = [(p << 64) // parts for p in range(parts)]
    return [*np.searchsorted(keys, np.array(edges, np.uint64)).tolist(), len(keys)]


def _ask_words(blocks, parts):
    """The block's words with their training counts, a row for each partition."""

    def run(batches):
        for batch in batches:
            for block, a, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                keys, counts = unpack_sorted(a), unpack(c)
                cuts = _slices(keys, parts)
                for p, (i, j) in enumerate(zip(cuts, cuts[1:])):
                    if j > i:
                        row = {"block": block, "kind": "ask", "part": p}
                        yield _rows([row | {"a": pack_sorted(keys[i:j]), "b": pack(counts[i:j])}])

    return blocks.select("block", "a", "c").mapInArrow(run, _ROW)


def _count_words(parts):
    """One partition of the word table, and a reply to each block: counts and numbers of its words.

    A word's number is (rank by count in the partition) * parts + partition + 1.
    """

    def run(table):
        part = table.column("part")[0].as_py()
        rows = table.select(["block", "a", "b"]).to_pylist()
        asked = [unpack_sorted(r["a"]) for r in rows]
        words, place = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.bincount(place, np.concatenate([unpack(r["b"]) for r in rows]).astype(float), len(words)).astype(np.int64)
        ranks = np.empty(len(words), np.int64)
        ranks[np.argsort(-counts, kind="stable")] = np.arange(len(words))
        numbers = ranks * parts + part + 1
        out, at = [], 0
        for r, own in zip(rows, asked):
            here = place[at : at + len(own)]
            at += len(own)
            out.append({"block": r["block"], "kind": "words", "part": part, "a": pack(counts[here]), "b": pack(numbers[here])})
        few = np.bincount(np.minimum(counts, K + 2), minlength=K + 3)[: K + 2].astype(float)
        stat = [*few, float(counts.sum()), float((counts > 0).sum())]
        out.append({"kind": "word table", "part": part, "a": pack_sorted(words), "b": pack(counts), "c": pack(numbers), "stat": stat})
        return _table(out)

    return run


class _Own:
    """A block with the replies of the word partitions."""

    def __init__(self, rows):
        block = next(r for r in rows if r["kind"] == "block")
        replies = sorted((r for r in rows if r["kind"] == "words"), key=lambda r: r["part"])
        self.block, self.docs, self.held = block["block"], block["docs"], np.array(block["held"], bool)
        self.sizes = np.array(block["sizes"], np.int64)
        seen = unpack(block["b"], np.int64)
        by_rank = np.argsort(-seen, kind="stable")
        place = by_rank[unpack(block["d"], np.int64)]
        self.counts = np.concatenate([unpack(r["a"], np.int64) for r in replies])
        self.numbers = np.concatenate([unpack(r["b"], np.int64) for r in replies])
        self.word_counts = self.counts[place]
        number = self.numbers[place]
        heads = np.cumsum(self.sizes) - self.sizes
        before = np.roll(number, 1)
        self.context_counts = np.roll(self.word_counts, 1)
        before[heads] = START
        self.heads = heads
        self.train = np.repeat(~self.held, self.sizes)
        # Distinct bigrams in order, and the place of each token's among them.
        bigrams = before.astype(np.uint64) << np.uint64(32) | number.astype(np.uint64)
        self.bigrams, self.first, self.place = np.unique(bigrams, return_index=True, return_inverse=True)

    def starts(self, n):
        """The context "start" occurs once per training document."""
        self.context_counts[self.heads] = n


def _parts_of(own, parts, words):
    """The partition of each distinct bigram: by context, by follower too where that is frequent."""
    v = own.bigrams >> np.uint64(32)
    spread = (own.context_counts[own.first] * SPREAD > words.total) | (v == START)
    with np.errstate(over="ignore"):
        key = W.mix(np.where(spread, own.bigrams, v))
    return (key % np.uint64(parts)).astype(np.int64), spread


def _ask_bigrams(parts, words):
    def run(table):
        own = _Own(table.to_pylist())
        own.starts(words.starts)
        train = np.bincount(own.place[own.train], minlength=len(own.bigrams))
        part, spread = _parts_of(own, parts, words)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        follower = own.word_counts[own.first]
        out = []
        for p, (i, j) in enumerate(zip(cuts, cuts[1:])):
            if j > i:
                at = order[i:j]
                # Counts of the bigram and of its follower, and whether its context is spread.
                facts = follower[at] * 2 + spread[at]
                row = {"block": own.block, "kind": "ask", "part": p}
                out.append(row | {"a": pack_sorted(own.bigrams[at]), "b": pack(train[at]), "c": pack(facts)})
        return _table(out)

    return run


def _facts(keys, counts, probabilities):
    """Of each context in sorted keys of seen bigrams: (context, facts), a row of facts for each.

    Facts: how many followers have each count from 1 to K, the sum of larger
    counts, the sum of the followers' P(w).
    """
    contexts = keys >> np.uint64(32)
    heads = np.flatnonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]])) if len(keys) else np.zeros(0, int)
    facts = np.zeros((len(heads), K + 2))
    if len(heads):
        for r in range(1, K + 1):
            facts[:, r - 1] = np.add.reduceat((counts == r).astype(float), heads)
        facts[:, K] = np.add.reduceat(np.where(counts > K, counts, 0).astype(float), heads)
        facts[:, K + 1] = np.add.reduceat(probabilities, heads)
    return contexts[heads], facts


def _count_bigrams(words):
    """One partition of the bigram table and of its contexts, and a reply to each block.

    The reply has the counts of the block's bigrams and the facts of those
    contexts that back off in it, or whose counts have no discount.
    """

    def run(table):
        part = table.column("part")[0].as_py()
        rows = table.select(["block", "a", "b", "c"]).to_pylist()
        asked = [unpack_sorted(r["a"]) for r in rows]
        keys, first, place = np.unique(np.concatenate(asked), return_index=True, return_inverse=True)
        facts = np.concatenate([unpack(r["c"], np.int64) for r in rows])[first]
        counts = np.bincount(place, np.concatenate([unpack(r["b"], np.int64) for r in rows]).astype(float), len(keys)).astype(np.int64)
        seen = counts > 0
        spread = (facts & 1).astype(bool)
        contexts, own_facts = _facts(keys[seen], counts[seen], words.probability(facts[seen] >> 1))
        is_spread = np.isin(contexts, keys[seen & spread] >> np.uint64(32))
        plain = ~own_facts[:, :K].any(axis=1)
        out, at = [], 0
        for r, own in zip(rows, asked):
            here = place[at : at + len(own)]
            at += len(own)
            needed = np.unique((own >> np.uint64(32))[counts[here] == 0])
            own_contexts = np.unique(own >> np.uint64(32))
            wanted = ~is_spread & (np.isin(contexts, needed) | (plain & np.isin(contexts, own_contexts)))
            out.append({
                "block": r["block"], "kind": "bigrams", "part": part, "a": pack(counts[here]),
                "b": pack_sorted(contexts[wanted]), "c": pack(own_facts[wanted].ravel()),
            })
        few = np.bincount(np.minimum(counts, K + 2), minlength=K + 3)[: K + 2].astype(float)
        out.append({
            "kind": "bigram table", "part": part, "a": pack_sorted(keys[seen]), "b": pack(counts[seen]),
            "c": pack_sorted(contexts), "d": pack(own_facts.ravel()), "stat": few,
        })
        for v, f in zip(contexts[is_spread].tolist(), own_facts[is_spread]):
            out.append({"kind": "spread", "part": v, "stat": f})
        return _table(out)

    return run


# --- scores


def _score(parts, words, d, spread_facts):
    def run(table):
        rows = table.to_pylist()
        own = _Own(rows)
        own.starts(words.starts)
        part, _ = _parts_of(own, parts, words)
        order = np.argsort(part, kind="stable")
        counts = np.zeros(len(own.bigrams), np.int64)
        replies = sorted((r for r in rows if r["kind"] == "bigrams"), key=lambda r: r["part"])
        counts[order] = np.concatenate([unpack(r["a"], np.int64) for r in replies])
        known = [(unpack_sorted(r["b"]), unpack(r["c"], np.float64).reshape(-1, K + 2)) for r in replies]
        known.append((np.array(list(spread_facts), np.uint64), np.array(list(spread_facts.values())).reshape(-1, K + 2)))
        contexts, facts = np.concatenate([k for k, _ in known]), np.concatenate([f for _, f in known])
        by_context = np.argsort(contexts)
        contexts, facts = contexts[by_context], facts[by_context]

        v = own.bigrams >> np.uint64(32)
        n = own.context_counts[own.first].astype(float)
        single = words.probability(own.word_counts[own.first])
        # Of each context: the share its seen followers use, whether none is discounted, their P(w).
        used = facts[:, :K] @ (d[1:] * np.arange(1, K + 1)) + facts[:, K]
        plain = ~facts[:, :K].any(axis=1)
        single_used = facts[:, K + 1]
        # A last row stands for contexts that nothing is known of and nothing asked.
        at = np.searchsorted(contexts, v)
        contexts = np.append(contexts, np.uint64(1) << np.uint64(63))
        at[contexts[at] != v] = len(used)
        has = at < len(used)
        used, plain, single_used = np.append(used, 0.0), np.append(plain, False), np.append(single_used, 0.0)
        # Without a discounted count, the context's own count grows by one.
        n += plain[at]
        discount = np.where(counts <= K, d[np.minimum(counts, K)], 1.0)
        safe = np.maximum(n, 1)
        backoff = np.where(has, (1 - used[at] / safe) / np.maximum(1 - single_used[at], 1e-300), 1.0)
        p = np.where(counts > 0, discount * counts / safe, backoff * single)
        logs = np.log10(p)[own.place]
        base = np.log10((own.word_counts + 0.5) / (words.total + 0.5 * (words.distinct + 1)))
        total = lambda x: np.add.reduceat(x, own.heads) if len(own.heads) else x
        n_docs = len(own.docs)
        return pa.table({
            "doc_id": pa.array(own.docs, pa.int64()),
            "held_out": pa.array(own.held),
            "n_tokens": pa.array(own.sizes),
            "n_known": pa.array(total((own.word_counts > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(n_docs, words.total, np.int64)),
            "base_score": pa.array(total(base)),
            "score": pa.array(total(logs)),
        })

    return run


_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _release(spark):
    """Let Spark delete the shuffle files of finished steps now, not at some later garbage collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _sums(rows, kind, size):
    stats = rows.where(F.col("kind") == kind).agg(*[F.coalesce(F.sum(F.col("stat")[i]), F.lit(0.0)) for i in range(size)])
    return list(stats.first())


def score_documents(docs, held_column="held_out", id_column="doc_id", text_column="text"):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs``.

    Learns from the rows whose ``held_column`` is false (null counts as held
    out) and scores all. ``score`` is the log10 probability of the document's
    tokens, its end included; ``base_score`` the same by add-a-half counts of
    single words; ``n_known`` the tokens that the training rows have.

    Defined results: a null text counts as empty, a document of its end alone;
    null ids stay and repeated rows are learned and scored as often as they
    come. Without training rows every word is unknown and certain (score 0).
    Other columns are ignored; an empty table gives no rows. Whole texts count.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"),
        F.coalesce(F.col(held_column).cast("boolean"), F.lit(True)).alias("held_out"),
    )
    blocks = materialize(_blocks(rows))
    parts = max(8, blocks.count())
    starts = blocks.select(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    asked = _ask_words(blocks, parts).repartition(parts, "part")
    counted = materialize(asked.groupBy("part").applyInArrow(_count_words(parts), _ROW))
    *n, total, distinct = _sums(counted, "word table", K + 4)
    words = Words(n, int(total), int(distinct), int(starts))
    _release(spark)

    replies = counted.where("kind = 'words'")
    own = blocks.unionByName(replies).repartition(parts, "block")
    asked = own.groupBy("block").applyInArrow(_ask_bigrams(parts, words), _ROW)
    bigrams = materialize(asked.groupBy("part").applyInArrow(_count_bigrams(words), _ROW))
    d = discounts(_sums(bigrams, "bigram table", K + 2))
    spread = bigrams.where("kind = 'spread'").groupBy("part")
    spread = spread.agg(F.array(*[F.sum(F.col("stat")[i]) for i in range(K + 2)]).alias("facts"))
    spread_facts = {r[0]: r[1] for r in spread.collect()}
    _release(spark)

    own = blocks.unionByName(replies).unionByName(bigrams.where("kind = 'bigrams'"))
    return own.repartition(parts, "block").groupBy("block").applyInArrow(_score(parts, words, d, spread_facts), _SCORED)
