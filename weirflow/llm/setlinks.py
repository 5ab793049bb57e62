"""Links between shingle sets that meet in groups, decided on the whole sets without pairing up a group.

Records are rows (rec, n, b0 to b7): a name, the size of the set and parity bits of its elements. Sets are rows (rec, all). Two sets are
linked if 100 * intersection >= percent * union.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import by_shuffle, stored

WORDS = 8
BITS = [f"b{k}" for k in range(WORDS)]


def parities(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One row of WORDS words per set: the parity of how many of its elements fall in each of 64 * WORDS cells."""
    cells = np.repeat(np.arange(len(sizes)), sizes) * (64 * WORDS) + (values & np.uint64(64 * WORDS - 1)).astype(np.int64)
    odd = np.bincount(cells, minlength=len(sizes) * 64 * WORDS).astype(np.uint8) & np.uint8(1)
    return np.packbits(odd.reshape(len(sizes), 64 * WORDS), axis=1).view(np.int64)


def may_be_near(a: str, b: str, percent: int) -> str:
    """No linked pair fails this: the sizes, and the different shingles, of which each changes one parity bit at most."""
    apart = " + ".join(f"bit_count({a}.{w} ^ {b}.{w})" for w in BITS)
    total = f"(CAST({a}.n AS BIGINT) + {b}.n)"
    return f"100L * {a}.n >= {percent}L * {b}.n AND 100L * {b}.n >= {percent}L * {a}.n AND {100 + percent} * ({apart}) <= {100 - percent} * {total}"


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs a, b whose whole sets are similar enough."""
    left = sets.select(F.col("rec").alias("a"), F.col("all").alias("x"))
    right = sets.select(F.col("rec").alias("b"), F.col("all").alias("y"))
    near = f"{100 + percent} * size(array_intersect(x, y)) >= {percent} * (CAST(size(x) AS BIGINT) + size(y))"
    return pairs.join(by_shuffle(left), "a").join(by_shuffle(right), "b").where(near).select("a", "b")


def _grouped(batches: Iterable[pa.RecordBatch], work) -> Iterator[pa.RecordBatch]:
    """``work`` on the rows of one group after the other; rows come sorted by ``g``, and one group at a time is held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        g = batch.column("g").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist(), len(g)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and held[0].column("g")[0].as_py() != g[a]:
                yield from work(pa.Table.from_batches(held).combine_chunks())
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield from work(pa.Table.from_batches(held).combine_chunks())


def _likely(n: np.ndarray, bits: np.ndarray, root: np.ndarray, i: int, percent: int) -> np.ndarray:
    """Rows after row ``i`` in another component that may be near it."""
    both = n[i + 1 :] + n[i]
    apart = np.bitwise_count(bits[i + 1 :] ^ bits[i]).sum(axis=1, dtype=np.int64)
    least, most = np.minimum(n[i + 1 :], n[i]), np.maximum(n[i + 1 :], n[i])
    return i + 1 + np.flatnonzero((root[i + 1 :] != root[i]) & (100 * least >= percent * most) & ((100 + percent) * apart <= (100 - percent) * both))


def _columns(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rec, root, n = (group.column(c).to_numpy() for c in ("rec", "root", "n"))
    return rec, root.copy(), n.astype(np.int64), np.column_stack([group.column(b).to_numpy() for b in BITS]).view(np.uint64)


def _candidates(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Records of each group with another one of the group that they may be near."""

    def work(group: pa.Table) -> Iterator[pa.RecordBatch]:
        rec, root, n, bits = _columns(group)
        some = np.zeros(len(rec), dtype=bool)
        for i in range(len(rec) - 1):
            found = _likely(n, bits, root, i, percent)
            some[found] = True
            some[i] |= len(found) > 0
        at = np.flatnonzero(some)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), group.column("g")[0].as_py())), pa.array(rec[at]), pa.array(root[at])], names=["g", "rec", "root"])

    return _grouped(batches, work)


def _confirmed(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links between the records of each group, by their whole sets; what links have joined already is not compared again."""

    def work(group: pa.Table) -> Iterator[pa.RecordBatch]:
        rec, root, n, bits = _columns(group)
        flat = group.column("all").combine_chunks()
        ends, values = flat.offsets.to_numpy(), flat.values.to_numpy()
        sets = [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        links = []
        for i in range(len(rec) - 1):
            for j in _likely(n, bits, root, i, percent).tolist():
                if root[i] != root[j]:
                    shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if (100 + percent) * shared >= percent * int(n[i] + n[j]):
                        links.append((i, j))
                        root[root == root[j]] = root[i]
        pick = lambda k: pa.array(rec[[x[k] for x in links]] if links else np.zeros(0, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pick(0), pick(1)], names=["a", "b"])

    return _grouped(batches, work)


def _dealt(rows: DataFrame, key: list[str], blocks: str) -> DataFrame:
    """Adds g, the group of a row: one for each ``key``, or for every two blocks of its rows where it has more than one block."""
    own = rows.withColumn("_blocks", F.expr(f"CAST({blocks} AS INT)")).withColumn("_own", F.expr("CAST(pmod(xxhash64(rec), _blocks) AS INT)"))
    other = own.withColumn("_other", F.explode(F.expr("CASE WHEN _blocks = 1 THEN array(0) ELSE filter(sequence(0, _blocks - 1), x -> x <> _own) END")))
    g = F.xxhash64(*key, F.least("_own", "_other"), F.greatest("_own", "_other"))
    return other.select(g.alias("g"), *[c for c in rows.columns if c not in {"g", *key}])


def compared(members: DataFrame, records: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int, block: int, group_shingles: int) -> DataFrame:
    """a, b: links between records of one node (node, m, rec, root, n, b0 to b7; m rows a node) that lie in different components.

    Signatures are compared first; only records that may be near another one are sent on with their whole sets, which ``sets`` gives. A task holds one group: two
    blocks of about ``block`` records, or of about ``group_shingles`` shingles in the second step. It sends on at most one row per record.
    """
    groups = _dealt(members, ["node"], f"ceil(m / {block})").repartition("g").sortWithinPartitions("g")
    some = stored(groups.mapInArrow(lambda b: _candidates(b, percent), "g bigint, rec bigint, root bigint"), "candidates")
    full = some.join(by_shuffle(records.select("rec", "n", *BITS)), "rec")
    sizes = full.groupBy("g").agg(F.sum("n").alias("_size"))
    dealt = _dealt(full.join(sizes, "g").withColumnRenamed("g", "_g"), ["_g"], f"ceil(_size / {group_shingles})").drop("_size")
    whole = dealt.join(by_shuffle(sets(some.select("rec").distinct())), "rec").repartition("g").sortWithinPartitions("g")
    return whole.mapInArrow(lambda b: _confirmed(b, percent), "a bigint, b bigint")
