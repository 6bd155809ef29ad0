"""Approximate nearest neighbours by learned partitions.

A bounded sample of vectors gives a neighbour graph, which is cut into parts of nearly equal
size with few edges between them. A small classifier learns the part of a vector; it places every vector of the
table and ranks the parts for a query, which is compared exactly with the vectors of its most probable parts. How
many parts a query visits is measured on the sample. Vectors of a part and its queries meet in
slices of bounded size, so a part of any size is many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import pick, query, table
from ledgerloom.sources.staging import stage

#: Most vectors that a fit reads: those with the smallest id hashes.
SAMPLE = 8192
#: Neighbours in the graph; parts at least and at most, and vectors for which there is one more part.
DEGREE, FEWEST, MOST, PER_PART = 10, 16, 128, 20_000
#: How much larger than the mean a part of the graph may be; hidden units; training steps.
SLACK, HIDDEN, STEPS = 1.1, 64, 200
#: Recall on the sample that decides the number of parts visited; queries that measure it.
RECALL, TRIALS = 0.97, 256
#: Vectors and queries that meet in a task.
SLICE, QUERIES = 16_384, 4_096
NEAREST = 20


def _top(scores, count: int):
    import numpy as np

    if scores.shape[1] <= count:
        return np.argsort(-scores, axis=1, kind="stable")
    part = np.argpartition(-scores, count - 1, axis=1)[:, :count]
    order = np.take_along_axis(scores, part, 1).argsort(axis=1)[:, ::-1]
    return np.take_along_axis(part, order, 1)


def neighbour_graph(x, degree: int = DEGREE):
    """Indices of each row's nearest rows by inner product, itself left out."""
    import numpy as np

    found = []
    for at in range(0, len(x), 1024):
        scores = x[at: at + 1024] @ x.T
        scores[np.arange(len(scores)), at + np.arange(len(scores))] = -np.inf
        found.append(_top(scores, min(degree, len(x) - 1)))
    return np.concatenate(found)


def _balanced(gain, most: int):
    """Part of each row by descending gain, no part above ``most``; rows that stand out choose first."""
    import numpy as np

    ranked = np.argsort(-gain, axis=1, kind="stable")
    best = np.take_along_axis(gain, ranked[:, :2], 1)
    order = np.argsort(-(best[:, 0] - best[:, -1]), kind="stable")
    room = np.full(gain.shape[1], most)
    part = np.empty(len(gain), np.int64)
    for i in order.tolist():
        for p in ranked[i].tolist():
            if room[p]:
                part[i], room[p] = p, room[p] - 1
                break
    return part


def cut_graph(x, graph, parts: int, rounds: int = 12, seed: int = 5):
    """Balanced parts of the neighbour graph: balanced k-means, then rows move to where their neighbours are."""
    import numpy as np

    draw = np.random.default_rng(seed)
    most = int(np.ceil(len(x) / parts * SLACK))
    centres = x[draw.choice(len(x), parts, replace=False)].copy()
    for _ in range(rounds):
        part = _balanced(x @ centres.T, most)
        for p in range(parts):
            if (part == p).any():
                centres[p] = x[part == p].mean(axis=0)
                centres[p] /= max(np.linalg.norm(centres[p]), 1e-12)
    row, col = np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (row, part[col]), 1.0)
        np.add.at(votes, (col, part[row]), 1.0)
        # a small pull to the old place keeps ties from swapping for ever
        votes[np.arange(len(x)), part] += 0.5
        part = _balanced(votes, most)
    return part


@dataclass(frozen=True)
class Router:
    """A classifier with one hidden layer, and how many parts a query visits."""

    first: object
    second: object
    parts: int
    visits: int

    def log_odds(self, x):
        import numpy as np

        one = np.c_[x, np.ones(len(x))]
        return np.c_[np.tanh(one @ self.first), one] @ self.second


def train_router(x, part, parts: int, steps: int = STEPS, seed: int = 5) -> tuple:
    """Weights of the classifier, by Adam on the cross entropy."""
    import numpy as np

    draw = np.random.default_rng(seed)
    one = np.c_[x, np.ones(len(x))]
    w = [draw.normal(0, 1 / np.sqrt(one.shape[1]), (one.shape[1], HIDDEN)), np.zeros((HIDDEN + one.shape[1], parts))]
    state = [[np.zeros_like(v), np.zeros_like(v)] for v in w]
    gold = np.zeros((len(x), parts))
    gold[np.arange(len(x)), part] = 1.0
    for step in range(1, steps + 1):
        hidden = np.tanh(one @ w[0])
        both = np.c_[hidden, one]
        z = both @ w[1]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = (p - gold) / len(x)
        grads = [one.T @ ((slope @ w[1][:HIDDEN].T) * (1 - hidden**2)), both.T @ slope]
        for v, g, s in zip(w, grads, state, strict=True):
            g = g + 1e-5 * v
            s[0] = 0.9 * s[0] + 0.1 * g
            s[1] = 0.99 * s[1] + 0.01 * g * g
            v -= 0.03 * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.99**step)) + 1e-8)
    return tuple(w)


def fit(x, total: int) -> Router:
    """A router from sample vectors of a table with ``total`` vectors."""
    import numpy as np

    parts = min(MOST, max(FEWEST, total // PER_PART), max(1, len(x) // 32))
    if parts == 1:
        return Router(np.zeros((x.shape[1] + 1, HIDDEN)), np.zeros((HIDDEN + x.shape[1] + 1, 1)), 1, 1)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    weights = train_router(x, cut_graph(unit, neighbour_graph(unit), parts), parts)
    router = Router(*weights, parts, parts)
    placed = router.log_odds(x)
    own = placed.argmax(axis=1)
    trial = np.linspace(0, len(x) - 1, min(TRIALS, len(x))).astype(int)
    scores = x[trial] @ x.T
    scores[np.arange(len(trial)), trial] = -np.inf
    true = _top(scores, min(NEAREST, len(x) - 1))
    order = np.argsort(-placed[trial], axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(parts)[None, :], 1)
    needed = np.take_along_axis(rank, own[true], 1)
    visits = next(v for v in range(1, parts + 1) if (needed < v).mean() >= RECALL or v == parts)
    return Router(*weights, parts, visits)


def _clean(vectors: DataFrame) -> DataFrame:
    """Rows (id, x) that take part: finite, not zero, of the most common length, with an id."""
    x = F.col("x").cast("array<double>")
    huge = float("inf")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(huge)))
    good = vectors.where("id is not null and x is not null").select("id", x.alias("x")).where(
        F.coalesce(whole, F.lit(False)) & F.exists("x", lambda v: v != 0)
    )
    return good.withColumn("d", F.size("x"))


def search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", nearest: int = NEAREST, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each row whose id is divisible by ``every``.

    Nearness is the inner product in double precision, ties go to the smaller id, a query's own id is no
    candidate. Rows that are null, zero, not finite or of another length than most take no part. An empty
    table gives no rows.
    """
    import numpy as np

    rows = _clean(pick(vectors, id=id_col, x=vector_col))
    spark = rows.sparkSession
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"query_id {kind}, vec_id {kind}, score double"
    lengths = rows.groupBy("d").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    size, total = lengths["d"], lengths["n"]
    rows = rows.where(F.col("d") == size).select("id", "x")
    # at most SAMPLE vectors
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("x").collect()
    router = fit(np.array([r["x"] for r in sample], float), total)

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            order = np.argsort(-router.log_odds(x), axis=1, kind="stable").astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1).cast(pa.list_(pa.float64())), pa.array(order[:, 0]),
                pa.array(order.tolist(), pa.list_(pa.int32())),
            ], ["id", "x", "part", "order"])

    placed = stage(rows.mapInArrow(place, f"id {kind}, x array<double>, part int, order array<int>"), "vectors")
    held = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    # so many parts that any query meets enough candidates
    few, visits = sorted(held.get(p, 0) for p in range(router.parts)), router.visits
    while visits < router.parts and sum(few[:visits]) <= nearest:
        visits += 1
    asked = placed.where(F.pmod(F.col("id"), F.lit(every)) == 0).select(
        "id", "x", F.explode(F.slice("order", 1, visits)).alias("part")
    )
    queries = {r["part"]: r["n"] for r in asked.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}

    def pieces(counts: dict, limit: int):
        if not counts:
            return F.lit(1)
        return F.create_map(*[F.lit(v) for p, n in counts.items() for v in (int(p), int(-(-n // limit)))])[F.col("part")]

    n_slices, n_groups = pieces(held, SLICE), pieces(queries, QUERIES)
    left = placed.where(F.col("part").isin([int(p) for p in queries])).select(
        "part", F.pmod(F.xxhash64("id"), n_slices).cast("bigint").alias("slice"), F.explode(F.sequence(F.lit(0), n_groups - 1)).alias("group"), "id", "x"
    )
    right = asked.where(F.col("part").isin([int(p) for p in held])).select(
        "part", F.explode(F.sequence(F.lit(0).cast("bigint"), (n_slices - 1).cast("bigint"))).alias("slice"),
        F.pmod(F.xxhash64("id"), n_groups).cast("int").alias("group"), "id", "x",
    )

    def compare(these, those):
        import pyarrow as pa

        out_q, out_v, out_s = [], [], []
        if these.num_rows and those.num_rows:
            x = these.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            q = those.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            ids, asking = these.column("id").to_numpy(), those.column("id").to_numpy()
            step = max(1, 4_000_000 // len(x))
            for at in range(0, len(q), step):
                rough = q[at: at + step] @ x.T
                for n, scores in enumerate(rough):
                    own = asking[at + n]
                    count = min(nearest + int((ids == own).sum()), len(x))
                    least = np.partition(scores, len(x) - count)[len(x) - count]
                    # the product's rounding depends on its blocks: whatever is close is computed anew, alike for all
                    near = np.flatnonzero(scores >= least - 1e-9 * max(1.0, abs(least)))
                    near = near[ids[near] != own]
                    exact = (x[near] * q[at + n]).sum(axis=1)
                    best = np.lexsort((ids[near], -exact))[:nearest]
                    out_q += [own] * len(best)
                    out_v.append(ids[near][best])
                    out_s.append(exact[best])
        join = np.concatenate
        return pa.table([
            pa.array(out_q, these.schema.field("id").type), pa.array(join(out_v) if out_v else [], these.schema.field("id").type),
            pa.array(join(out_s) if out_s else [], pa.float64()),
        ], ["query_id", "vec_id", "score"])

    keys = ["part", "slice", "group"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


@query("op4_neighbours")
def op4(spark: SparkSession, root: str) -> DataFrame:
    """The 20 nearest rows found for every 20th vector."""
    return search(table(spark, root, "embeddings"))
