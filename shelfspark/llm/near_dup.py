"""Near-duplicate documents: a chosen-path set similarity join over minwise tokens, confirmed on full shingle sets.

Documents with equal shingle sets form one class, and the join runs over classes. Each of TREES independent trees gives
a class one or two branches at each of its first two levels: a branch is the value of one minwise token, and all classes
of a node choose the same tokens, so classes with similarity s stay together in at least one branch with probability
near s or above (the expected number of shared branches at 0.8 is one). Nodes of up to NODE_ROWS classes are compared
exhaustively on 256 packed minwise digits; larger ones branch again, level by level. After DEEP_LEVELS more levels the
classes of a node share so many tokens that they are copies of one text; such a node is cut by a hash into blocks, other
ones in each tree, which joins the copies cheaply; after that all its blocks are compared with each other, but for pairs
within a component. Nothing is dropped for being frequent, and no node is gathered in a task as a whole.

Within a node all pairs are compared but few are sent on: the edges of FORESTS edge-disjoint maximum spanning forests.
They keep every two classes connected that the node's candidate pairs connect, even where FORESTS - 1 of the edges
between them fail the confirmation, so a group of n copies costs n pairs, not n * n. Candidates are confirmed on
their full sets, and components are taken over the confirmed links.

Rows of candidates that were kept back then meet once more, node by node, with the component that each belongs to so far:
first by their digits; those that are in a candidate pair between two components come again with their full sets, every such
pair is confirmed inside the task, and a spanning forest of the links that hold is sent on. So each candidate pair was
confirmed, failed on its full sets, or lies within a component, and no table has a row for each pair.

Rows grow with the documents, but for nodes above NODE_ROWS after all levels: there each row (its 128 bytes of digits) goes to every other
block of its node, so the rows of a family of n different texts that can't be told apart by tokens are n * n / NODE_ROWS * 2; full
sets follow only where a candidate pair between two components is left.

At similarity 0.8 exactly, a pair is missed by one tree with probability 0.27 (0.36 two levels deeper), by all
TREES = 12 with 2e-7 (5e-6); the digit filter misses it with 3e-6. Similar pairs above 0.8 are missed less often.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import materialise, scratch, shuffle_partitions
from shelfspark.llm.components import connected_components
from shelfspark.llm.textbytes import U, binary_column, matrix, mix, ragged_binary, shingle_sets, text_chunks

#: Words of a shingle, unless the caller says otherwise.
WORDS = 5
TREES = 12
TOKENS_A_TREE = 8
DIGITS = 256
#: Of the 256 digits of two classes with similarity 0.8, 208 are expected to agree (deviation 6.2).
AGREE = 180
#: A node's weight is its number of classes, each counted once more for every WEIGHT_SHINGLES shingles, so that it bounds memory.
NODE_ROWS = 2500
WEIGHT_SHINGLES = 1024
DEEP_LEVELS = 3
BLOCK_ROWS = 500
PORTION_PAIRS = 1_000_000
#: Rows of 40 bytes.
BROADCAST_ROWS = 250_000
FORESTS = 3
#: Shingles that are looked at together when the sets of a node are compared.
TILE = 8192
PAIRS_AT_ONCE = 1 << 14
BATCH_PAIRS = 100_000
NONE = (1 << 32) - 1

SKETCH_SCHEMA = "key long, doc_id long, n long, cls binary, digits binary, nodes array<long>"
ROW_SCHEMA = "kind int, a binary, b binary, node long, n long, digits binary"


def _minima(sets: np.ndarray, off: np.ndarray) -> np.ndarray:
    """For each non-empty set its DIGITS minwise tokens (32 bits each)."""
    rng = np.random.default_rng(20240229)
    mul = rng.integers(0, 1 << 31, DIGITS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    xor = rng.integers(0, 1 << 32, DIGITS, dtype=np.uint32)
    low = (sets >> U(32)).astype(np.uint32)
    out = np.empty((len(off) - 1, DIGITS), np.uint32)
    for c in range(DIGITS):
        out[:, c] = np.minimum.reduceat((low ^ xor[c]) * mul[c], off[:-1])
    return out


def _nodes(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The node keys of each row after two levels of every tree, flattened, and how many each row has."""
    keys, there = [], []
    for t in range(TREES):
        for i in range(2 if t % 4 == 0 else 1):
            first = mix(m[:, TOKENS_A_TREE * t + i].astype(U) * U(0x9E3779B97F4A7C15) + U(1 + 2 * t + i))
            for j in range(2):
                second = m[:, TOKENS_A_TREE * t + 2 + 2 * i + j].astype(U)
                keys.append(mix(first + second * U(0xBF58476D1CE4E5B9) + U(j)))
                # a quarter of the nodes, chosen by the node, branch on a second token
                there.append(np.ones(len(m), bool) if j == 0 else (first >> U(60)) % U(4) == 0)
    keys, there = np.stack(keys, 1), np.stack(there, 1)
    return keys[there], there.sum(1)


def _classes(sets: np.ndarray, off: np.ndarray, n: np.ndarray) -> np.ndarray:
    """16 bytes that identify each row's set; of an empty set zeros."""
    out = np.zeros((len(n), 2), U)
    some = n > 0
    for k, salt in enumerate((0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)):
        out[some, k] = mix(np.add.reduceat(mix(sets ^ U(salt)), off[:-1][some]) + n[some].astype(U)) if some.any() else out[some, k]
    return out


def _sketch(words: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, row_off in text_chunks(batch.column("text")):
                sets, off = shingle_sets(buf, row_off, words)
                n = np.diff(off)
                some = n > 0
                tokens = _minima(sets, np.append(off[:-1][some], len(sets))) if some.any() else np.zeros((0, DIGITS), np.uint32)
                # the low bits of a minimum lean to small values in no way that the top bits do
                low = (mix(tokens.astype(U)) & U(15)).astype(np.uint8)
                digits = np.zeros((hi - lo, DIGITS // 2), np.uint8)
                digits[some] = low[:, 0::2] | (low[:, 1::2] << 4)
                flat, counts = _nodes(tokens)
                per_row = np.zeros(hi - lo, np.int64)
                per_row[some] = counts
                nodes = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)), pa.array(flat.view(np.int64)))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("doc_id"), pa.array(n), binary_column(_classes(sets, off, n).view(np.uint8).reshape(-1, 16)), binary_column(digits), nodes],
                    names=["key", "doc_id", "n", "cls", "digits", "nodes"],
                )

    return step


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of the packed digits agree, row by row."""
    d = x ^ y
    d |= d >> U(1)
    d |= d >> U(2)
    d &= U(0x1111111111111111)
    return DIGITS - np.bitwise_count(d).sum(1, dtype=np.int64)


def spanning_edges(i: np.ndarray, j: np.ndarray, weight: np.ndarray, n: int, forests: int) -> np.ndarray:
    """The positions of the edges of so many edge-disjoint maximum spanning forests (Boruvka's method, all parts at once)."""
    left = np.argsort(-weight, kind="stable").astype(np.int32)  # ties keep the order of the rows
    taken = []
    for _ in range(forests):
        label, open_, forest = np.arange(n), left, []
        while open_.size:
            a, b = label[i[open_]], label[j[open_]]
            cross = a != b
            open_, a, b = open_[cross], a[cross], b[cross]
            if not open_.size:
                break
            best, at = np.full(n, len(open_)), np.arange(len(open_))
            best[a[::-1]] = at[::-1]
            other = np.full(n, len(open_))
            other[b[::-1]] = at[::-1]
            best = np.minimum(best, other)
            roots = np.flatnonzero(best < len(open_))
            pick = best[roots]
            forest.append(np.unique(open_[pick]))
            parent = np.arange(n)
            parent[roots] = np.where(a[pick] == roots, b[pick], a[pick])
            mutual = parent[parent] == np.arange(n)
            parent[mutual] = np.minimum(parent[mutual], np.flatnonzero(mutual))
            while (parent[parent] != parent).any():
                parent = parent[parent]
            label = parent[label]
        if not forest:
            break
        chosen = np.unique(np.concatenate(forest))
        taken.append(chosen)
        left = left[~np.isin(left, chosen)]
    return np.concatenate(taken) if taken else np.zeros(0, np.int64)


def _candidates(node: np.ndarray, n: np.ndarray, digits: np.ndarray, root: np.ndarray | None = None, part: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows, sorted by node and size, that share a node and AGREE digits or more, with the number of these digits.

    A row meets those of its node that have up to a quarter more shingles. Rows that share a root don't meet, nor do
    rows of a same part, if it isn't negative.
    """
    ends = np.append(np.flatnonzero(node[1:] != node[:-1]) + 1, len(node))
    end = np.repeat(ends, np.diff(np.concatenate([[0], ends])))
    at, step, found = np.arange(len(node)), 1, []
    while at.size:
        at = at[at + step < end[at]]
        at = at[5 * n[at] >= 4 * n[at + step]]
        for k in range(0, len(at), 1 << 16):
            some = at[k : k + (1 << 16)]
            if root is not None:
                some = some[(root[some] != root[some + step]) & ((part[some] < 0) | (part[some] != part[some + step]))]
            same = _agreeing(digits[some], digits[some + step])
            if (hit := same >= AGREE).any():
                found.append((some[hit].astype(np.int32), (some[hit] + step).astype(np.int32), same[hit].astype(np.int16)))
        step += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _pairs(node: np.ndarray, n: np.ndarray, digits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The candidate pairs of FORESTS spanning forests, and the rows of the pairs that are left out."""
    i, j, same = _candidates(node, n, digits)
    keep = spanning_edges(i, j, same, len(node), FORESTS)
    left = np.ones(len(i), bool)
    left[keep] = False
    return i[keep], j[keep], np.unique(np.concatenate([i[left], j[left]]))


def shared_counts(values: np.ndarray, off: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many values the sets i and j share, pair by pair; set k has the distinct values from off[k] to off[k + 1].

    Values that several sets have become bits, TILE of them at a time in the order of the sets, so memory is bounded by
    the number of sets and of pairs.
    """
    shared = np.zeros(len(i), np.int64)
    if not len(i):
        return shared
    used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    i, j = at[: len(i)], at[len(i) :]
    size = np.diff(off)[used]
    owner = np.repeat(np.arange(len(used)), size)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    _, first, which, count = np.unique(values[np.repeat(off[:-1][used], size) + inside], return_index=True, return_inverse=True, return_counts=True)
    common = np.flatnonzero(count > 1)
    place = np.full(len(count), -1)
    place[common[np.argsort(first[common])]] = np.arange(len(common))
    place = place[which]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for lo in range(0, len(common), TILE):
        a, b = np.searchsorted(place, [lo, lo + TILE])
        dense = np.zeros((len(used), TILE), bool)
        dense[owner[a:b], place[a:b] - lo] = True
        bits, there = np.packbits(dense, axis=1).view(U), dense.any(1)
        both = np.flatnonzero(there[i] & there[j])
        for k in range(0, len(both), PAIRS_AT_ONCE):
            some = both[k : k + PAIRS_AT_ONCE]
            shared[some] += np.bitwise_count(bits[i[some]] & bits[j[some]]).sum(1, dtype=np.int64)
    return shared


def _portions(node: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of whole nodes with up to PORTION_PAIRS pairs and 2 * NODE_ROWS rows, or one node."""
    ends = np.append(np.flatnonzero(node[1:] != node[:-1]) + 1, len(node))
    first, pairs, last = 0, 0, 0
    for end in ends.tolist():
        size = end - last
        if last > first and (pairs + size * size // 2 > PORTION_PAIRS or end - first > 2 * NODE_ROWS):
            yield first, last
            first, pairs = last, 0
        pairs += size * size // 2
        last = end
    yield first, last


def _ordered(a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
    """Two columns of class ids (big-endian words), the smaller one of each pair first."""
    swap = (a[:, 0] > b[:, 0]) | ((a[:, 0] == b[:, 0]) & (a[:, 1] > b[:, 1]))
    a[swap], b[swap] = b[swap], a[swap]
    return [binary_column(x.astype(">u8").view(np.uint8).reshape(-1, 16)) for x in (a, b)]


def _compare(limit: int):
    """Rows sorted by node -> pairs (kind 0) of nodes with up to limit rows, the rows (kind 1) of larger ones, and those (kind 2) of pairs that were kept back."""

    def records(kind: int, a, b, node, n, digits) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), a, b, node, n, digits], names=["kind", "a", "b", "node", "n", "digits"])

    def rows_of(t: pa.RecordBatch, kind: int = 1) -> pa.RecordBatch:
        return records(kind, t.column("cls"), pa.nulls(len(t), pa.binary()), t.column("node"), t.column("n"), t.column("digits"))

    def pairs_of(t: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        node, n = np.asarray(t.column("node")), np.asarray(t.column("n"))
        i, j, cut = _pairs(node, n, matrix(t.column("digits"), DIGITS // 2, U))
        cls = matrix(t.column("cls"), 16, ">u8")
        for k in range(0, len(i), BATCH_PAIRS):
            ids = _ordered(cls[i[k : k + BATCH_PAIRS]], cls[j[k : k + BATCH_PAIRS]])
            m = len(ids[0])
            yield records(0, *ids, pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()))
        if len(cut):
            yield rows_of(t.take(pa.array(cut)), 2)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: pa.RecordBatch | None = None
        large: int | None = None

        def settle(t: pa.RecordBatch, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal carried, large
            node = np.asarray(t.column("node"))
            starts = np.concatenate([[0], np.flatnonzero(node[1:] != node[:-1]) + 1, [len(node)]])
            sizes = np.diff(starts)
            over = sizes > limit
            if large is not None and node[0] == large:
                over[0] = True
            keep_from = len(node)
            large = None
            if not last:
                if over[-1]:
                    large = int(node[-1])
                else:
                    keep_from = int(starts[-2])
            carried = t.slice(keep_from) if keep_from < len(node) else None
            big = np.repeat(over, sizes)[:keep_from]
            done = t.slice(0, keep_from)
            if big.any():
                yield rows_of(done.filter(pa.array(big)))
            if not big.all():
                small = done.filter(pa.array(~big))
                # dense nodes have edges by the square of their size: a few nodes at a time
                for a, b in _portions(np.asarray(small.column("node"))):
                    yield from pairs_of(small.slice(a, b - a))

        for batch in batches:
            for k in range(0, len(batch), 50_000):
                part = batch.slice(k, 50_000)
                t = pa.concat_batches([carried, part]) if carried is not None else part
                if len(t):
                    yield from settle(t, False)
        if carried is not None and len(carried):
            yield from settle(carried, True)

    return step


def _branch(level: int):
    """Two children for each row: the node chooses two bytes of the packed digits, two minwise tokens in each."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            node = np.asarray(batch.column("node")).view(U)
            digits = matrix(batch.column("digits"), DIGITS // 2, np.uint8)
            for child in range(2):
                at = (mix(node + U(977 * level + child)) % U(DIGITS // 2)).astype(np.int64)
                value = digits[np.arange(len(node)), at].astype(U)
                key = mix(node * U(0x9E3779B97F4A7C15) + value * U(0xD1B54A32D192ED03) + U(2 * level + child))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *(batch.column(c) for c in ("cls", "n", "digits"))], names=["node", "cls", "n", "digits"])

    return step


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with roots and parts, sorted by node -> those that are in a candidate pair of their node between two roots."""

    def found(t: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a, b in _portions(np.asarray(t.column("node"))):
            some = t.slice(a, b - a)
            columns = (np.asarray(some.column(c)) for c in ("node", "n"))
            i, j, _ = _candidates(*columns, matrix(some.column("digits"), DIGITS // 2, U), np.asarray(some.column("root")), np.asarray(some.column("part")))
            if len(i):
                yield some.take(pa.array(np.unique(np.concatenate([i, j]))))

    for t in _whole_nodes(batches):
        yield from found(t)


def _whole_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by node, cut anew so that each holds whole nodes."""
    carried: pa.RecordBatch | None = None
    for batch in batches:
        t = pa.concat_batches([carried, batch]) if carried is not None else batch
        if len(t):
            node = np.asarray(t.column("node"))
            start = int(np.searchsorted(node[::-1] != node[-1], True))
            carried = t.slice(len(t) - start)
            if start < len(t):
                yield t.slice(0, len(t) - start)
    if carried is not None:
        yield carried


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with full sets, roots and parts, sorted by node -> (u, v): a spanning forest of each node's links between roots.

    A node is at most NODE_ROWS of weight, and whole nodes are all that is held at a time.
    """

    def links(t: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        node, n, root, part = (np.asarray(t.column(c)) for c in ("node", "n", "root", "part"))
        i, j, same = _candidates(node, n, matrix(t.column("digits"), DIGITS // 2, U), root, part)
        if not len(i):
            return
        grams = t.column("grams").cast(pa.large_binary())
        off = np.frombuffer(grams.buffers()[1], np.int64)[grams.offset : grams.offset + len(t) + 1]
        values = np.frombuffer(grams.buffers()[2], np.uint8)[off[0] : off[-1]].view(U)
        off = (off - off[0]) // 8
        shared, size = shared_counts(values, off, i, j), np.diff(off)
        good = np.flatnonzero(100 * shared >= 80 * (size[i] + size[j] - shared))
        i, j, same = i[good], j[good], same[good]
        vertex = np.unique(mix(node.view(U)) ^ mix(root.view(U) + U(1)), return_inverse=True)[1]
        keep = spanning_edges(vertex[i], vertex[j], same, int(vertex.max()) + 1, 1)
        cls = matrix(t.column("cls"), 16, ">u8")
        yield pa.RecordBatch.from_arrays(_ordered(cls[i[keep]], cls[j[keep]]), names=["u", "v"])

    def whole(t: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a, b in _portions(np.asarray(t.column("node"))):
            yield from links(t.slice(a, b - a))

    for t in _whole_nodes(batches):
        yield from whole(t)


def _full_sets(words: int):
    """The full sets of the texts whose class is the wanted one (a repeated doc_id may bring others)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, row_off in text_chunks(batch.column("text")):
                sets, off = shingle_sets(buf, row_off, words)
                cls = binary_column(_classes(sets, off, np.diff(off)).view(np.uint8).reshape(-1, 16))
                out = pa.RecordBatch.from_arrays([cls, ragged_binary(sets, off)], names=["cls", "grams"])
                want = batch.slice(lo, hi - lo).column("want")
                yield out.filter(pa.array([x == y for x, y in zip(cls.to_pylist(), want.to_pylist(), strict=True)], pa.bool_()))

    return step


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("ga"), batch.column("gb"), strict=True):
            p, q = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
            both = np.concatenate([p, q])
            both.sort()
            shared = int(np.count_nonzero(both[1:] == both[:-1]))
            keep.append(100 * shared >= 80 * (len(p) + len(q) - shared))
        yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _by_node(rows: DataFrame) -> DataFrame:
    return rows.repartition("node").sortWithinPartitions("node", "n", "cls")


def candidate_pairs(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """classes(cls, n, digits, nodes) -> distinct (a, b), a < b, that some node of some tree sends on; and the rows
    (node, cls, n, digits) of candidates that were kept back, or of nodes that were cut into blocks."""
    spark = classes.sparkSession
    rows = classes.select(F.explode("nodes").alias("node"), "cls", "n", "digits")
    pairs, partial = [], []
    for level in range(DEEP_LEVELS + 2):
        blocks = level == DEEP_LEVELS + 1
        if blocks:
            partial.append(rows.select("node", "cls", "n", "digits"))
            size = rows.groupBy("node").agg(F.count("*").alias("rows"))
            rows = rows.join(size, "node").select(F.xxhash64("node", F.pmod(F.xxhash64("cls", "node"), F.ceil(F.col("rows") / BLOCK_ROWS))).alias("node"), "cls", "n", "digits")
            ready, huge = rows, None
        else:
            # nodes that would fill a good part of a task skip the shuffle: at most four for each partition
            total = rows.count() if level else None
            many = NODE_ROWS if total is None else max(NODE_ROWS, total // (4 * shuffle_partitions(spark)))
            hot = rows.groupBy("node").agg(F.count("*").alias("rows")).filter(F.col("rows") > many).select("node")
            hot = materialise(hot, "nodes")
            ready, huge = rows.join(hot, "node", "left_anti"), rows.join(hot, "node", "left_semi")
        done = materialise(_by_node(ready).mapInArrow(_compare(1 << 60 if blocks else NODE_ROWS), ROW_SCHEMA), "compared")
        pairs.append(done.filter("kind = 0").select("a", "b"))
        if blocks:
            break
        partial.append(done.filter("kind = 2").select("node", F.col("a").alias("cls"), "n", "digits"))
        rest = done.filter("kind = 1").select("node", F.col("a").alias("cls"), "n", "digits").unionByName(huge.select("node", "cls", "n", "digits"))
        if rest.isEmpty():
            break
        rows = materialise(rest.mapInArrow(_branch(level), "node long, cls binary, n long, digits binary"), "rows") if level < DEEP_LEVELS else materialise(rest, "rows")
    return reduce(DataFrame.union, pairs).distinct(), reduce(DataFrame.union, partial)


def _dealt(rows: DataFrame) -> DataFrame:
    """rows(node, cls, n, digits, root) with their part, without nodes of a single root; a node of more than NODE_ROWS of weight becomes one
    node for each two of its blocks. A root with many rows has blocks of its own, which don't meet each other."""
    block = max(BLOCK_ROWS, NODE_ROWS // 2)
    groups = rows.groupBy("node", "root").agg(F.sum(1 + F.floor(F.col("n") / WEIGHT_SHINGLES)).alias("rows"))
    sizes = materialise(groups.groupBy("node").agg(F.sum("rows").alias("all"), F.count("*").alias("roots")).filter("roots > 1").select("node", "all"), "sizes")
    whole = rows.join(sizes.filter(F.col("all") <= NODE_ROWS).select("node"), "node", "left_semi").withColumn("part", F.lit(-1))
    large = sizes.filter(F.col("all") > NODE_ROWS).select("node")
    if large.isEmpty():
        return whole
    alone = F.col("rows") >= block
    groups = groups.join(large, "node", "left_semi").select("node", "root", "rows", alone.alias("alone"), F.when(alone, F.col("root")).otherwise(F.lit(0)).alias("set"))
    groups = materialise(groups, "groups")
    counts = groups.groupBy("node", "alone", "set").agg(F.ceil(F.sum("rows") / block).alias("blocks"))
    blocks = materialise(counts.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))), "blocks")
    at = F.struct("alone", "set", "block")
    x, y = blocks.select("node", at.alias("x")), blocks.select("node", at.alias("y"))
    tasks = x.join(y, "node").filter((F.col("x") <= F.col("y")) & ~(F.col("x.alone") & F.col("y.alone") & (F.col("x.set") == F.col("y.set"))))
    within = F.col("x") == F.col("y")
    sides = F.when(within, F.array(F.struct(F.lit(-1).alias("part"), F.col("x").alias("at")))).otherwise(F.array(*(F.struct(F.lit(k).alias("part"), F.col(c).alias("at")) for k, c in enumerate("xy"))))
    sides = tasks.select("node", F.xxhash64("node", "x", "y").alias("task"), F.explode(sides).alias("side")).select("node", "task", "side.part", "side.at.alone", "side.at.set", "side.at.block")
    found = rows.join(groups.select("node", "root", "alone", "set"), ["node", "root"]).join(counts, ["node", "alone", "set"]).withColumn("block", F.pmod(F.xxhash64("cls", "node"), F.col("blocks")))
    cut = found.join(sides, ["node", "alone", "set", "block"]).select(F.col("task").alias("node"), "cls", "n", "digits", "root", "part")
    return whole.select(*cut.columns).union(cut)


def settled(partial: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v): links between classes of partial's nodes that no confirmed link has joined so far, so many that all links among
    these nodes are joined then. Rows meet by their digits first, and only those in a candidate pair are sent again with their full
    sets; copies, which have a root in common, don't meet."""
    known = partial.join(roots.select(F.col("node").alias("cls"), F.xxhash64("root").alias("root")), "cls", "left")
    rows = materialise(known.select("node", "cls", "n", "digits", F.coalesce("root", F.xxhash64("cls")).alias("root")), "partial")
    dealt = _dealt(rows)
    met = materialise(_by_node(dealt).mapInArrow(_meet, dealt.schema), "met")
    return materialise(_by_node(met.join(sets, "cls")).mapInArrow(_settle, "u binary, v binary"), "links")


def full_sets(wanted: DataFrame, classes: DataFrame, keyed: DataFrame, words: int) -> DataFrame:
    """(cls, grams) for every class of wanted(cls), built from the texts of keyed(key, text)."""
    wanted = materialise(wanted.select(F.col("cls").alias("want")).distinct().join(classes.select(F.col("cls").alias("want"), "key"), "want"), "wanted")
    # few wanted texts are picked where they lie; for many, texts are shuffled once
    small = wanted.count() <= BROADCAST_ROWS
    found = keyed.select("key", "text").join(F.broadcast(wanted) if small else wanted, "key")
    return materialise(found.mapInArrow(_full_sets(words), "cls binary, grams binary").groupBy("cls").agg(F.min("grams").alias("grams")), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of pairs(a, b) whose full sets are similar enough, as (u, v). The hub of a star of copies is sent with each of them, so
    what is shuffled follows the size of the copies; a join on a hub is one that Spark may split."""
    both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("grams").alias("ga")), "a").join(sets.select(F.col("cls").alias("b"), F.col("grams").alias("gb")), "b")
    return materialise(both.select(F.col("a").alias("u"), F.col("b").alias("v"), "ga", "gb").mapInArrow(_confirm, "u binary, v binary"), "links")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, class_id, class_links) for each row of docs.

    A set holds the distinct shingles of so many words of the whole text, lower-cased in A-Z only; fewer words are one
    shingle. Documents are linked at Jaccard similarity 0.8 or more. class_id names the set (hex), class_links counts
    the confirmed links that were drawn from it to other sets (a spanning selection, not all that exist).

    Null and empty texts, and texts of blanks only, have no shingles: they are linked with nothing and kept. Repeated
    rows and ids: rows of a set share a component whatever their ids; each row whose id is the component's smallest is
    kept. A row with a null id has its component's smallest id and is not kept, unless it is alone or all of its component's
    ids are null (component_id null, kept). An empty table gives an empty result. Other columns are neither read nor returned.
    """
    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    keyed = given.withColumn("key", F.coalesce("doc_id", F.xxhash64("text")))
    sketched = materialise(keyed.mapInArrow(_sketch(words), SKETCH_SCHEMA), "sketches", keep=True)
    with scratch(docs.sparkSession):
        whole = sketched.filter("n > 0")
        classes = whole.groupBy("cls").agg(F.min("doc_id").alias("least"), F.min(F.struct("key", "n", "digits", "nodes")).alias("x")).select("cls", "least", "x.*")
        classes = materialise(classes, "classes")
        pairs, partial = candidate_pairs(classes.select("cls", "n", "digits", "nodes"))
        pairs = materialise(pairs, "pairs")
        ends = [pairs.select(F.col(c).alias("cls")) for c in "ab"]
        sets = full_sets(reduce(DataFrame.union, [*ends, partial.select("cls")]), classes, keyed, words)
        links = confirmed(pairs, sets)
        roots = connected_components(links)
        if not partial.isEmpty():
            links = links.union(settled(partial, roots, sets))
            roots = connected_components(links)
        member = classes.select("cls", "least").join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        smallest = member.groupBy("root").agg(F.min("least").alias("component_id"))
        degree = links.select(F.col("u").alias("cls")).union(links.select(F.col("v").alias("cls"))).groupBy("cls").agg(F.count("*").alias("class_links"))
        label = materialise(member.join(smallest, "root").join(degree, "cls", "left").select("cls", "component_id", "class_links"), "labels", keep=True)
    out = sketched.select("doc_id", "n", F.when(F.col("n") > 0, F.col("cls")).alias("cls")).join(label, "cls", "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("doc_id").eqNullSafe(F.col("component_id"))).otherwise(F.lit(True)).alias("kept"),
        F.lower(F.hex("cls")).alias("class_id"), F.coalesce("class_links", F.lit(0).cast("long")).alias("class_links"),
    )
