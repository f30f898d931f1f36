"""Matrix factorisation.

* ``fit_als``: Spark ML ``ALS`` (block ALS on the JVM) on dense integer codes
  of the ids. Grid search: the same steps from the same start for all (rank, λ)
  side by side on blocks, each scored on train and test.
* ``dense_als``: the local notebook's variant where every unrated cell is an
  observed 0 and the penalty is plain λ (ledger Q18). Since zeros add
  nothing to ``Σ r·y``, each half step is: k×k Gram of the fixed side
  (k² numbers to the driver), its regularised inverse, and per row
  ``A · Σ r·y``. No dense matrix is ever built: users are hashed into blocks,
  and an iteration is one pass over them (``DenseRuns``).
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.session import checkpoint_dir, removed, scratch_folder, written

# ------------------------------------------------------------------ Spark ML ALS


def fit_als(train: DataFrame, rank: int, iterations: int, reg: float, seed: int = 11,
            user="user_id", item="item_id", rating="rating"):
    """Checkpoints after every iteration: only then does ALS drop the messages
    that its iterations have shuffled, which are many times the ratings."""
    checkpoint_dir(train.sparkSession)
    als = ALS(rank=rank, maxIter=iterations, regParam=reg, seed=seed, userCol=user, itemCol=item,
              ratingCol=rating, coldStartStrategy="drop", nonnegative=False, checkpointInterval=1)
    return als.fit(train)


def als_mse(model, df: DataFrame, rating="rating") -> float:
    p = model.transform(df)
    r = p.agg(F.avg(F.pow(F.col(rating) - F.col("prediction"), 2)).alias("mse")).first()
    return float(r["mse"]) if r["mse"] is not None else float("nan")


def grid_search(train: DataFrame, test: DataFrame, ranks, iterations, regs, seed: int = 11,
                user="user_id", item="item_id", rating="rating", at_once: int = 4):
    """Every (rank, iterations, λ) fit; a run table with train and test MSE
    (ledger Q17), a function that fits the best model by train MSE, as the
    original chooses it (R13), and its setting.

    All λ of a rank go side by side from Spark ML's own start (a fit of no
    iterations), ``at_once`` ranks at a time, and the shorter fits are recorded
    on the way of the longest (``ExplicitRuns``)."""
    from concurrent.futures import ThreadPoolExecutor
    spark = train.sparkSession
    checkpoint_dir(spark)  # ALS cuts its own lineage there
    train = train.select(user, item, rating).cache()
    runs = [(rk, float(lam)) for rk in sorted(set(ranks)) for lam in regs]
    made = None
    try:
        train.count()
        with ThreadPoolExecutor(at_once) as pool:
            starts = list(pool.map(lambda rk: fit_als(train, rk, 0, 0.0, seed, user, item, rating).userFactors, sorted(set(ranks))))
        cells = [df.select(F.col(user).alias("u"), F.col(item).alias("i"), F.col(rating).cast("double").alias("rating")) for df in (train, test)]
        made = ExplicitRuns(*cells)
        with ThreadPoolExecutor(at_once) as pool:
            found = list(pool.map(lambda rk, start: made.errors(start, [r for r in runs if r[0] == rk], set(iterations)), sorted(set(ranks)), starts))
        errors = {it: [e for of_rank in found for e in of_rank[it]] for it in set(iterations)}
    finally:
        train.unpersist()
        if made is not None:
            made.close()
    done = [(rk, it, lam, *errors[it][runs.index((rk, float(lam)))]) for it in iterations for rk in ranks for lam in map(float, regs)]
    best = min(done, key=lambda d: (d[3], d[:3]))[:3]
    table = spark.createDataFrame(done, "rank int, iterations int, reg double, mse_train double, mse_test double")
    return table, lambda: fit_als(train, *best, seed, user, item, rating), best


def best_run(runs: DataFrame, metric="mse_train") -> DataFrame:
    """Row with the smallest ``metric`` (A15); ties go to the smaller setting."""
    top = F.min(F.struct(F.col(metric), "rank", "iterations", "reg")).alias("best")
    return runs.agg(top).select("best.rank", "best.iterations", "best.reg", F.col("best")[metric].alias(metric))


def pivot_runs(runs: DataFrame, y="mse_train") -> DataFrame:
    """One row per (rank, λ), a column per number of iterations."""
    its = sorted(r[0] for r in runs.select("iterations").distinct().collect())
    return runs.groupBy("rank", "reg").pivot("iterations", its).agg(F.first(y))


def curves(runs: DataFrame, series="rank", x="reg", y="mse_train") -> DataFrame:
    """One ordered (x, y) series per ``series`` value."""
    pts = F.sort_array(F.collect_list(F.struct(F.col(x).alias("x"), F.col(y).alias("y"))))
    return runs.groupBy(series, "iterations").agg(pts.alias("points"))


#: Factor rows of a block of users and of items, and items scored at once.
TOP_USERS, TOP_ITEMS, TOP_STEP = 1 << 10, 1 << 16, 1 << 10


def _factor_blocks(factors: DataFrame, size: int, names: tuple) -> DataFrame:
    """(block, ids, factors) of at most ``size`` rows (id, features) each, single precision."""
    block, ids, f = names

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for b in batches:
            for at in range(0, b.num_rows, size):
                part = b.slice(at, size)
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([part.column(0).to_numpy().astype(np.int32).tobytes()]),
                                                  pa.array([_matrix(part.column(1)).astype(np.float32).tobytes()])], [block, ids, f])
                number += 1

    return written(factors.select("id", "features").mapInArrow(run, f"{block} long, {ids} binary, {f} binary"), "blocks")


def best_products(u: np.ndarray, v: np.ndarray, n: int):
    """(row of u, row of v, product) of the ``n`` largest products of each row of
    u, ties to the smaller row of v; some rows of v at a time, and of these only
    products above the n-th best so far are looked at."""
    row, col, best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    least, across, room = np.full(len(u), -np.inf, np.float32), np.ascontiguousarray(v.T), np.empty((len(u), TOP_STEP), np.float32)
    for at in range(0, len(v), TOP_STEP):
        some = across[:, at:at + TOP_STEP]
        s = np.matmul(u, some, out=room) if some.shape[1] == TOP_STEP else u @ some
        if not at and s.shape[1] > n:
            least = np.nextafter(np.partition(s, -n, axis=1)[:, -n], np.float32(-np.inf))
        some = np.flatnonzero(s.max(axis=1) > least)
        if not len(some):
            continue
        r, c = np.nonzero(s[some] > least[some, None])
        r = some[r]
        row, col, best = np.concatenate((row, r)), np.concatenate((col, c + at)), np.concatenate((best, s[r, c]))
        order = np.lexsort((col, -best, row))
        row, col, best = row[order], col[order], best[order]
        first = np.concatenate(([True], row[1:] != row[:-1]))
        place = np.arange(len(row)) - np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))
        kept = place < n
        row, col, best, place = row[kept], col[kept], best[kept], place[kept]
        full = place == n - 1
        least[row[full]] = best[full]
    return row, col, best


def top_n(model, n: int, users: DataFrame, user: str, item: str) -> DataFrame:
    """(user, item, rating, pos) of the ``n`` best items of each of the given
    users that has factors, ties to the smaller item (R11). Blocks of users meet
    all blocks of items; of each meeting a task keeps ``n`` rows a user."""
    asked = model.userFactors.join(users.select(F.col(user).alias("id")).distinct(), "id", "left_semi")
    asked = _factor_blocks(asked, TOP_USERS, ("_ub", "_u", "_uf"))
    offered = _factor_blocks(model.itemFactors.orderBy("id"), TOP_ITEMS, ("_ib", "_i", "_if"))
    pairs = asked.crossJoin(offered.select("_ib")).join(offered.hint("shuffle_hash"), "_ib").select("_u", "_uf", "_i", "_if")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for x in range(b.num_rows):
                ids, items = (np.frombuffer(b.column(c)[x].as_buffer(), np.int32) for c in ("_u", "_i"))
                f, g = (np.frombuffer(b.column(c)[x].as_buffer(), np.float32).reshape(len(k), -1) for c, k in (("_uf", ids), ("_if", items)))
                row, col, best = best_products(f, g, n)
                yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(items[col]), pa.array(best)], [user, item, "rating"])

    w = Window.partitionBy(user).orderBy(F.col("rating").desc(), F.col(item))
    scored = pairs.mapInArrow(run, f"{user} int, {item} int, rating float")
    return scored.withColumn("pos", F.row_number().over(w) - 1).where(F.col("pos") < n)


def top_n_named(model, n: int, users: DataFrame, names: DataFrame, item_key="p_partkey", name_col="p_name",
                user="user_id") -> DataFrame:
    """Top-``n`` items of the given users with names as columns
    recommend_1..n (R11, R12).

    One left join to the names and a conditional aggregate per rank, so a
    user missing a name keeps the row (ledger Q31).
    """
    flat = top_n(model, n, users, user, "_item")
    nm = names.select(F.col(item_key).alias("_item"), F.col(name_col).alias("name"))
    j = flat.join(nm, "_item", "left")
    aggs = [F.max(F.when(F.col("pos") == i, F.col("name"))).alias(f"recommend_{i + 1}") for i in range(n)]
    return j.groupBy(user).agg(*aggs).orderBy(user)


# ------------------------------------------------------------------ dense ALS


def hash_uniform(*cols):
    """Deterministic value in [0, 1) from md5 of the columns (seeded init)."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                                      for c in cols])), 1, 8), 16, 10)
    return h.cast("bigint").cast("double") / F.lit(4294967296.0)


def init_factors(ids: DataFrame, key: str, rank: int, seed: int = 3) -> DataFrame:
    """``key, f`` with f[c] = hash_uniform(key, c, seed)."""
    comps = [hash_uniform(key, F.lit(c), F.lit(seed)) for c in range(rank)]
    return ids.select(key, F.array(*comps).alias("f"))


#: Ratings in a block of users, and blocks for each core.
BLOCK_RATINGS, BLOCKS_PER_CORE = 1 << 20, 2
#: Numbers of factor rows that are summed up at once.
SUM_CELLS = 1 << 16
FACTORS, GRAM, ERRORS = 0, 1, 2


def rating_blocks(ratings: DataFrame) -> DataFrame:
    """Ratings (u, i, rating) as one row per block of users: its users and
    items, and of each rating the numbers of its user and item in them, by user;
    ``turn`` is the order by item. A null rating adds nothing to a sum. Users
    are hashed, so a hot item is in every block; a user has one rating an item."""
    spark, ratings = ratings.sparkSession, written(ratings, "ratings")  # counted, then dealt
    user, item = (ratings.schema[c].dataType.simpleString() for c in ("u", "i"))
    n = max(BLOCKS_PER_CORE * spark.sparkContext.defaultParallelism, -(-ratings.count() // BLOCK_RATINGS))

    def build(t):
        import pyarrow as pa

        users, items = (t.column(c).combine_chunks().dictionary_encode("encode") for c in ("u", "i"))
        row, col = (x.indices.to_numpy(zero_copy_only=False).astype(np.int32) for x in (users, items))
        by_user = np.argsort(row, kind="stable")
        row, col = row[by_user], col[by_user]
        rating = t.column("rating").to_numpy()[by_user]  # null: nan
        known = ~np.asarray(users.dictionary.is_null())[row]
        turn = np.argsort(col, kind="stable")
        turn = turn[known[turn]]
        return pa.Table.from_pydict({"b": t.column("b").slice(0, 1), "users": pa.array([users.dictionary.to_pylist()], pa.list_(t.schema.field("u").type)),
                                     "items": pa.array([items.dictionary.to_pylist()], pa.list_(t.schema.field("i").type)),
                                     "row": [row], "col": [col], "rating": [rating], "turn": [turn.astype(np.int32)]})

    block = F.pmod(F.xxhash64("u"), F.lit(n)).cast("int").alias("b")
    kind = f"b int, users array<{user}>, items array<{item}>, row array<int>, col array<int>, rating array<double>, turn array<int>"
    return ratings.select(block, "u", "i", "rating").groupBy("b").applyInArrow(build, kind).repartition(n, "b")


def weighted_sums(out: np.ndarray, to: np.ndarray, of: np.ndarray, weight: np.ndarray, table: np.ndarray) -> None:
    """Adds weight · table[of] to the rows ``to`` (ascending) of ``out``. Rows of
    as many terms are products of matrices together, a few numbers at a time."""
    if not len(to):
        return
    first = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
    counts, most = np.diff(np.append(first, len(to))), max(1, SUM_CELLS // table.shape[1])
    order = np.argsort(counts, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(counts[order])) + 1):
        n = int(counts[rows[0]])
        step = max(1, most // n)
        for at in (first[rows[a:a + step]] for a in range(0, len(rows), step)):
            for c in range(0, n, most):  # the terms of a row may be too many for one piece
                cells = at[:, None] + np.arange(c, min(n, c + most))
                out[to[at]] += (weight[cells][:, None, :] @ table[of[cells]])[:, 0]


class DenseRuns:
    """Dense ALS of several (rank, λ) runs side by side on blocks of users. A
    factor row holds those of all runs one after another. An iteration is one
    pass over the blocks: each gets the item factors it needs, solves its users
    and returns its share of the items' sums and of the users' Gram matrices.
    Users' factors never leave their block, so that what is shuffled grows with
    items × blocks (at most with the ratings); k² numbers of a run reach the
    driver. ``kind`` tells factors, Gram matrices and errors apart."""

    def __init__(self, ratings: DataFrame, runs: list, seed: int):
        self.runs, self.seed = runs, seed
        self.ends = np.cumsum([rk for rk, _ in runs])
        self.width = int(self.ends[-1])
        self.types = {c: ratings.schema[c].dataType.simpleString() for c in ("u", "i")}
        self.rows = f"kind int, i {self.types['i']}, s array<double>"
        self.blocks = rating_blocks(ratings).persist()
        self.needs = written(self.blocks.select("b", F.posexplode("items").alias("c", "i")).where("i is not null"), "needs")

    def spans(self):
        return [slice(int(e) - rk, int(e)) for e, (rk, _) in zip(self.ends, self.runs)]

    def start(self) -> DataFrame:
        """The first item factors: functions of the item."""
        spans = self.spans()
        most = max(rk for rk, _ in self.runs)
        ids = self.blocks.select(F.explode("items").alias("i")).distinct()
        first = ids.select("i", F.array(*[hash_uniform("i", F.lit(c), F.lit(self.seed)) for c in range(most)]).alias("s"))
        return self._with_gram(first, lambda s: np.concatenate([s[:, :x.stop - x.start] for x in spans], 1))

    def _with_gram(self, items: DataFrame, solve) -> DataFrame:
        spans = self.spans()

        def run(batches):
            total = None
            for b in batches:
                if b.num_rows:
                    f = solve(_matrix(b.column(1)))
                    total = _gram(f, spans) + (0 if total is None else total)
                    yield _rows(FACTORS, b.column(0), f)
            if total is not None:
                yield _rows(GRAM, None, total[None], b.schema.field(0).type)

        return written(items.select("i", "s").mapInArrow(run, self.rows), "factors")

    def inverses(self, sums: DataFrame) -> list:
        """Inverse of Gram matrix + λ of each run, from the rows of kind GRAM."""
        g = sums.where(F.col("kind") == GRAM).agg(Summarizer.sum(array_to_vector("s")).alias("g")).first()["g"]
        g = np.zeros(sum(rk * rk for rk, _ in self.runs)) if g is None else g.toArray()
        cut = np.split(g, np.cumsum([rk * rk for rk, _ in self.runs])[:-1])
        return [np.linalg.inv(x.reshape(rk, rk) + lam * np.eye(rk)) for x, (rk, lam) in zip(cut, self.runs)]

    def _with_items(self, *items: DataFrame) -> DataFrame:
        """Each block with the factors of its items (of several tables side by side)."""
        got = None
        for n, x in enumerate(items):
            x = x.where((F.col("kind") == FACTORS) & F.col("i").isNotNull()).select("i", F.col("s").alias(f"s{n}"))
            got = x if got is None else got.join(x, "i", "full")
        names = [f"s{n}" for n in range(len(items))]
        sent = self.needs.join(got, "i").groupBy("b").agg(F.collect_list(F.struct("c", *names)).alias("sent"))
        return self.blocks.join(sent.hint("shuffle_hash"), "b", "left")

    def _pass(self, items: tuple, inverses: list, kind: str, each) -> DataFrame:
        spans, width = self.spans(), self.width

        def run(batches):
            for b in batches:
                for n in range(b.num_rows):
                    yield from each(_Block(b.slice(n, 1), spans, width, inverses))

        return self._with_items(*items).mapInArrow(run, kind)

    def users(self, items: DataFrame, inverses: list) -> DataFrame:
        """(u, f) solved against the items."""
        def each(x):
            yield x.user_rows()

        return self._pass((items,), inverses, f"u {self.types['u']}, f array<double>", each)

    def step(self, items: DataFrame, inverses: list) -> DataFrame:
        """The items' new factors, from users solved against the old ones."""
        def each(x):
            f = x.solved()
            yield _rows(GRAM, None, _gram(f[x.solvable], x.spans)[None], x.items.type)
            sums, met = x.item_sums(f)
            yield _rows(FACTORS, x.items.filter(pa_array(met)), sums[met])

        spans = self.spans()
        sums = self._pass((items,), inverses, self.rows, each).groupBy("kind", "i").agg(Summarizer.sum(array_to_vector("s")).alias("s")) \
            .select("kind", "i", vector_to_array("s").alias("s")).persist()
        try:
            a = self.inverses(sums)
            return self._with_gram(sums.where(F.col("kind") == FACTORS), lambda s: np.concatenate([s[:, x] @ m for x, m in zip(spans, a)], 1))
        finally:
            sums.unpersist()

    def errors(self, items: DataFrame, new: DataFrame, inverses: list) -> list:
        """Mean squared error of each run over the rated cells, of the users
        solved against ``items`` and the factors ``new``; None without cells."""
        def each(x):
            yield _rows(ERRORS, None, x.squares(x.solved())[None], x.items.type)

        s = self._pass((items, new), inverses, self.rows, each).agg(Summarizer.sum(array_to_vector("s")).alias("s")).first()["s"]
        return [] if s is None or not s[0] else [float(x / s[0]) for x in s.toArray()[1:]]

    def close(self) -> None:
        self.blocks.unpersist()


def pa_array(x):
    import pyarrow as pa

    return pa.array(x)


def _matrix(lists) -> np.ndarray:
    """A column of number lists of one length as a matrix."""
    lists = lists.combine_chunks() if hasattr(lists, "combine_chunks") else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _lists(m: np.ndarray):
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(np.ascontiguousarray(m).ravel()))


def _rows(kind: int, keys, m: np.ndarray, key_type=None):
    import pyarrow as pa

    keys = pa.nulls(len(m), key_type) if keys is None else keys
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(m), kind, np.int32)), keys, _lists(m)], ["kind", "i", "s"])


def _gram(f: np.ndarray, spans: list) -> np.ndarray:
    """The Gram matrices of all runs one after another."""
    return np.concatenate([(f[:, x].T @ f[:, x]).ravel() for x in spans])


class _Block:
    """A block of users with the factors of its items, in a task."""

    def __init__(self, b, spans, width, inverses):
        def cell(name):
            return b.column(name).flatten()

        self.users, self.items, self.spans, self.inverses = cell("users"), cell("items"), spans, inverses
        self.row, self.col, self.turn = (cell(c).to_numpy() for c in ("row", "col", "turn"))
        rating = cell("rating").to_numpy(zero_copy_only=False)
        self.rated, self.rating = ~np.isnan(rating), np.nan_to_num(rating)
        sent = cell("sent")  # empty where no item of the block has factors
        at = sent.field("c").to_numpy() if len(sent) else np.zeros(0, np.int64)
        self.tables, self.has = [], []
        for n in range(1, sent.type.num_fields):
            lists = sent.field(n)
            mine = np.flatnonzero(~np.asarray(lists.is_null())) if len(sent) else at
            table, has = np.zeros((len(self.items), width)), np.zeros(len(self.items), bool)
            if len(mine):
                table[at[mine]], has[at[mine]] = _matrix(lists.drop_null()), True
            self.tables.append(table)
            self.has.append(has)
        #: users with a rating of an item that has factors
        self.solvable = np.bincount(self.row, self.has[0][self.col], len(self.users)) > 0

    def solved(self) -> np.ndarray:
        out = np.zeros((len(self.users), self.tables[0].shape[1]))
        weighted_sums(out, self.row, self.col, self.rating, self.tables[0])
        return np.concatenate([out[:, x] @ a for x, a in zip(self.spans, self.inverses)], 1)

    def user_rows(self):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays([self.users.filter(pa.array(self.solvable)), _lists(self.solved()[self.solvable])], ["u", "f"])

    def item_sums(self, f: np.ndarray):
        """The sums of the items, and which have a user with factors."""
        t = self.turn[self.solvable[self.row[self.turn]]]
        out = np.zeros((len(self.items), f.shape[1]))
        weighted_sums(out, self.col[t], self.row[t], self.rating[t], f)
        return out, np.bincount(self.col[t], minlength=len(self.items)) > 0

    def squares(self, f: np.ndarray) -> np.ndarray:
        """Rated cells whose user and item have factors, and the squared error of each run over them."""
        t = self.turn[(self.solvable[self.row] & self.has[1][self.col] & self.rated)[self.turn]]
        out, step = np.zeros(1 + len(self.spans)), max(1, (1 << 21) // f.shape[1])
        out[0] = len(t)
        for a in range(0, len(t), step):
            x = t[a:a + step]
            both = f[self.row[x]] * self.tables[1][self.col[x]]
            out[1:] += [np.square(self.rating[x] - both[:, s].sum(1)).sum() for s in self.spans]
        return out


def dense_als_path(ratings: DataFrame, rank: int, iterations: int, lam: float, seed: int = 3,
                   user="user_id", item="item_key"):
    """Yields (iteration, user factors, item factors) after every iteration,
    users solved first. Item factors are written after each; those of the users
    are worked out where they are read, the last ones written."""
    r = ratings.select(F.col(user).alias("u"), F.col(item).alias("i"), F.col("rating").cast("double").alias("rating"))
    d = DenseRuns(r, [(rank, lam)], seed)
    try:
        items = d.start()
        for it in range(1, iterations + 1):
            a = d.inverses(items)
            users, items = d.users(items, a), d.step(items, a)
            users = written(users, "factors") if it == iterations else users
            yield it, users.select(F.col("u").alias(user), "f"), \
                items.where(F.col("kind") == FACTORS).select(F.col("i").alias(item), F.col("s").alias("f"))
    finally:
        d.close()


def dense_als(ratings: DataFrame, rank: int, iterations: int, lam: float, seed: int = 3,
              user="user_id", item="item_key"):
    """Alternating exact solves; returns (user factors, item factors)."""
    out = None
    for out in dense_als_path(ratings, rank, iterations, lam, seed, user, item):
        pass
    return out[1], out[2]


def dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def predict_rated(cells: DataFrame, users: DataFrame, items: DataFrame, user="user_id",
                  item="item_key") -> DataFrame:
    """Predictions for given cells; a side without a factor predicts 0."""
    u = users.select(user, F.col("f").alias("fu"))
    i = items.select(item, F.col("f").alias("fi"))
    j = cells.join(u, user, "left").join(i, item, "left")
    p = F.when(F.col("fu").isNull() | F.col("fi").isNull(), F.lit(0.0)).otherwise(dot(F.col("fu"), F.col("fi")))
    return j.withColumn("prediction", p).drop("fu", "fi")


def top_cells(users: DataFrame, items: DataFrame, n: int = 10, user="user_id", item="item_key",
              block: int = 256) -> DataFrame:
    """The ``n`` best items of each given user (J10, R15), ties to the smaller
    item: a stated set of users, hashed into blocks, against all items. Items
    are copied once per block of users, and a task keeps ``n`` rows a user."""
    n_blocks = F.greatest(F.lit(1), F.ceil(users.agg(F.count(F.lit(1))).scalar() / block)).cast("bigint")
    asked = users.select(user, F.col("f").alias("fu"), F.pmod(F.xxhash64(user), n_blocks).alias("_b"))
    offered = items.select(item, F.col("f").alias("fi"), F.explode(F.sequence(F.lit(0).cast("bigint"), n_blocks - 1)).alias("_b"))
    scored = asked.join(offered, "_b").select(user, item, dot(F.col("fu"), F.col("fi")).alias("prediction"))
    w = Window.partitionBy(user).orderBy(F.col("prediction").desc(), F.col(item))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def dense_grid(ratings: DataFrame, ranks, iterations, regs, seed: int = 3, user="user_id", item="item_key") -> DataFrame:
    """MSE over the rated cells of every (rank, iterations, λ). All (rank, λ)
    runs go side by side, and the shorter runs are recorded on the way of the
    longest."""
    runs = [(rk, float(lam)) for lam in regs for rk in ranks]
    r = ratings.select(F.col(user).alias("u"), F.col(item).alias("i"), F.col("rating").cast("double").alias("rating"))
    d, rows = DenseRuns(r, runs, seed), []
    try:
        items = d.start()
        for it in range(1, max(iterations) + 1):
            a = d.inverses(items)
            new = d.step(items, a)
            if it in iterations:
                rows += [(rk, it, lam, mse) for (rk, lam), mse in zip(runs, d.errors(items, new, a))]
            items = new
    finally:
        d.close()
    return ratings.sparkSession.createDataFrame(rows, "rank int, iterations int, reg double, mse double")


# ------------------------------------------------------------------ explicit ALS side by side

#: Ratings in a block (the fewer blocks, the fewer copies of a factor row are
#: sent), and numbers of a task's factor rows held at once as doubles.
EXPLICIT_RATINGS, EXPLICIT_CELLS = 3 << 20, 1 << 19


def even_keys(spark, n: int) -> list:
    """``n`` numbers that a hash partitioning into ``n`` deals one to each."""
    some = spark.range(32 * n).select(F.col("id").cast("int").alias("k")).select("k", F.pmod(F.hash("k"), F.lit(n)).alias("p")) \
        .groupBy("p").agg(F.min("k").alias("k")).collect()
    keys = [r["k"] for r in some]
    return sorted(keys + [k for k in range(-1, -1 - n, -1)][:n - len(keys)])


class ExplicitRuns:
    """ALS on the rated cells as Spark ML has it, for several λ of a rank side by
    side: a factor row (single precision, as there) holds those of all runs one
    after another. Users and items are hashed into as many blocks; a block holds
    its ratings, and which of its rows each block of the other side needs. It
    gets those rows, one message from each block, and solves its normal
    equations. An iteration is two such steps. Each writes its factors and drops
    the messages and the factors before: disk holds one step of each rank."""

    def __init__(self, train: DataFrame, test: DataFrame):
        self.spark = spark = train.sparkSession
        known = test.join(train.select("u").distinct(), "u", "left_semi").join(train.select("i").distinct(), "i", "left_semi")  # others are dropped
        cells = train.withColumn("t", F.lit(False)).unionByName(known.withColumn("t", F.lit(True)))
        self.cells = written(cells.select("u", "i", "rating", "t"), "cells")
        cores = spark.sparkContext.defaultParallelism
        n = cores * max(1, -(-self.cells.count() // (cores * EXPLICIT_RATINGS)))
        self.keys = even_keys(spark, n)
        key = F.array(*[F.lit(k) for k in self.keys])
        side = lambda c: F.get(key, F.pmod(F.xxhash64(c), F.lit(n)).cast("int"))
        coded = self.cells.select("u", "i", "rating", "t", side("u").alias("bu"), side("i").alias("bi"))
        self.users, self.items = (
            self._blocks(coded.select(F.col(f"b{x}").alias("b"), F.col(x).alias("k"), F.col(f"b{y}").alias("ob"), F.col(y).alias("o"), "rating", "t"))
            for x, y in ("ui", "iu"))

    def _blocks(self, cells: DataFrame) -> DataFrame:
        n, keys = len(self.keys), np.array(self.keys)

        def build(t):
            import pyarrow as pa

            ids, row = np.unique(t.column("k").to_numpy(), return_inverse=True)
            other = np.searchsorted(keys, t.column("ob").to_numpy()).astype(np.int64) << 32  # ids are int codes
            need, src = np.unique(other + t.column("o").to_numpy(), return_inverse=True)
            out = np.unique(other + row)
            is_test, rating = t.column("t").to_numpy(zero_copy_only=False), t.column("rating").to_numpy()
            fit, held = np.flatnonzero(~is_test), np.flatnonzero(is_test)
            fit = fit[np.argsort(row[fit], kind="stable")]
            cell = {"ids": ids, "first": np.searchsorted(row[fit], np.arange(len(ids) + 1)), "src": src[fit], "out": out & 0xffffffff,
                    "out_first": np.searchsorted(out >> 32, np.arange(n + 1)), "test_row": row[held], "test_src": src[held]}
            return pa.Table.from_pydict({"b": t.column("b").slice(0, 1)} | {c: pa.array([v.astype(np.int32)], pa.list_(pa.int32())) for c, v in cell.items()}
                                        | {c: pa.array([rating[at]], pa.list_(pa.float64())) for c, at in (("rating", fit), ("test_rating", held))})

        kind = "b int, " + ", ".join(f"{c} array<int>" for c in ("ids", "first", "src", "out", "out_first", "test_row", "test_src"))
        blocks = cells.repartition(n, "b").groupBy("b").applyInArrow(build, kind + ", rating array<double>, test_rating array<double>")
        return blocks.repartition(n, "b").persist()

    def _first(self, start: DataFrame, times: int) -> DataFrame:
        """The users' first factors by blocks, as often as there are runs."""
        ids = self.users.select("b", F.explode("ids").alias("id")).join(start.select("id", F.col("features").alias("f")), "id")
        each = ids.groupBy("b").agg(F.sort_array(F.collect_list(F.struct("id", "f"))).alias("f"))

        def run(batches):
            import pyarrow as pa

            for b in batches:
                for x in range(b.num_rows):
                    f = np.tile(_matrix(b.column(1).slice(x, 1).flatten().field(1)), (1, times))
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(x, 1), pa.array([f.astype(np.float32).tobytes()])], ["b", "f"])

        return each.mapInArrow(run, "b int, f binary")

    def _step(self, of: DataFrame, factors: DataFrame, to: DataFrame, width: int, solve, kind: str) -> DataFrame:
        """``solve`` (block, factors) for the blocks ``to`` and the messages for
        them with the factors of the blocks ``of``, put together in the order of
        their senders. Messages are never one row."""
        keys = self.keys

        def send(batches):
            import pyarrow as pa

            for b in batches:
                for x in range(b.num_rows):
                    out, first, f = _cell(b, "out", x), _cell(b, "out_first", x), _floats(b.column("f")[x], width)
                    for d, key in enumerate(keys):
                        if first[d] < first[d + 1]:
                            v = pa.array([f[out[first[d]:first[d + 1]]].tobytes()])
                            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), b.column("b").slice(x, 1), v], ["b", "s", "v"])

        def run(got, block):
            import pyarrow as pa

            parts = sorted(zip(got.column("s").to_pylist(), got.column("v")), key=lambda x: x[0])
            rows = np.concatenate([_floats(v, width) for _, v in parts])
            return pa.Table.from_batches(solve(block.combine_chunks().to_batches()[0], rows))

        held = factors.select("b", "f").repartition(len(keys), "b").hint("shuffle_hash")
        sent = of.select("b", "out", "out_first").join(held, "b").mapInArrow(send, "b int, s int, v binary")
        return sent.repartition(len(keys), "b").groupBy("b").cogroup(to.groupBy("b")).applyInArrow(run, kind)

    def errors(self, start: DataFrame, runs: list, iterations: set) -> dict:
        """For each number of iterations, (train MSE, test MSE) of every run; the
        runs are of one rank, that of ``start``."""
        width = sum(rk for rk, _ in runs)

        def solved(b, of):
            return solved_rows(_cell(b, "first"), _cell(b, "src"), _cell(b, "rating"), of, runs)

        def solve_items(b, of):
            import pyarrow as pa

            yield pa.RecordBatch.from_arrays([b.column("b"), pa.array([solved(b, of).tobytes()])], ["b", "f"])

        def solve_users(b, of, scored):
            import pyarrow as pa

            first, src, rating = (_cell(b, c) for c in ("first", "src", "rating"))
            f = solved(b, of)
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))
            held = [_cell(b, c) for c in ("test_row", "test_src", "test_rating")]
            e = np.concatenate([squared_errors(f, of, *part, runs) for part in ((row, src, rating), held)]) if scored else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("b"), pa.array([f.tobytes()]), pa.array([e], pa.list_(pa.float64()))], ["b", "f", "e"])

        def table(df, before=None):
            path = scratch_folder(self.spark, "factors")
            df = written(df, path=path)
            if before:
                removed(self.spark, before)
            return df, path

        out = {}
        users, last = table(self._first(start, len(runs)))
        for it in range(1, max(iterations) + 1):
            scored = it in iterations
            items, last = table(self._step(self.users, users, self.items, width, solve_items, "b int, f binary"), last)
            users, last = table(self._step(self.items, items, self.users, width, lambda b, of, scored=scored: solve_users(b, of, scored),
                                           "b int, f binary, e array<double>"), last)
            if scored:
                e = np.sum([r["e"] for r in users.select("e").collect()], axis=0).reshape(2, -1)  # a few numbers of each block
                with np.errstate(invalid="ignore", divide="ignore"):
                    mse = e[:, 1:] / e[:, :1]  # none: nan
                out[it] = list(zip(mse[0].tolist(), mse[1].tolist()))
        removed(self.spark, last)
        return out

    def close(self) -> None:
        self.users.unpersist()
        self.items.unpersist()


def _cell(b, name: str, x: int = 0) -> np.ndarray:
    """The list in row ``x`` of a column of a batch."""
    return b.column(name).slice(x, 1).flatten().to_numpy()


def _floats(cell, width: int) -> np.ndarray:
    """The factor rows in a binary cell."""
    return np.frombuffer(cell.as_buffer(), np.float32).reshape(-1, width)


def solved_rows(first: np.ndarray, src: np.ndarray, rating: np.ndarray, table: np.ndarray, runs: list) -> np.ndarray:
    """The factors of all runs of each row whose ratings are ``first[r]`` to
    ``first[r + 1]``: least squares against ``table[src]``, the penalty λ times
    the number of the row's ratings. Rows of as many ratings are solved at once."""
    width, counts = table.shape[1], np.diff(first)
    out, most = np.zeros((len(counts), width), np.float32), max(1, EXPLICIT_CELLS // width)
    rating = rating.astype(np.float32).astype(np.float64)
    for n in np.unique(counts[counts > 0]):
        rows = np.flatnonzero(counts == n)
        step = max(1, most // max(1, n))
        for at in (rows[a:a + step] for a in range(0, len(rows), step)):
            left, right = {}, {}
            for c in range(0, n, most):  # the ratings of a row may be too many for one piece
                cells = first[at][:, None] + np.arange(c, min(n, c + most))
                f, r = table[src[cells]], rating[cells][:, None, None]
                for rk, cols, _ in run_groups(runs):
                    x = f[:, :, cols].reshape(*cells.shape, -1, rk).transpose(0, 2, 1, 3).astype(np.float64, order="C")
                    left[rk] = left.get(rk, 0.0) + x.transpose(0, 1, 3, 2) @ x
                    right[rk] = right.get(rk, 0.0) + r @ x
            for rk, cols, lams in run_groups(runs):
                a = left[rk] + (np.array(lams) * n)[:, None, None] * np.eye(rk)
                out[at, cols] = np.linalg.solve(a, right[rk].swapaxes(2, 3)).reshape(len(at), -1)
    return out


def run_groups(runs: list):
    """(rank, columns, λ of each run) of runs in the order of their ranks."""
    at = 0
    for rk in dict.fromkeys(rk for rk, _ in runs):
        lams = [lam for r, lam in runs if r == rk]
        yield rk, slice(at, at + rk * len(lams)), lams
        at += rk * len(lams)


def squared_errors(f: np.ndarray, table: np.ndarray, row: np.ndarray, src: np.ndarray, rating: np.ndarray, runs: list) -> np.ndarray:
    """Number of the given cells and their summed squared errors in each run."""
    ends = np.cumsum([rk for rk, _ in runs])
    starts, out, step = ends - [rk for rk, _ in runs], np.zeros(1 + len(runs)), max(1, EXPLICIT_CELLS // table.shape[1])
    out[0] = len(row)
    for a in range(0, len(row), step):
        x = slice(a, a + step)
        p = np.add.reduceat(f[row[x]].astype(np.float64) * table[src[x]], starts, axis=1).astype(np.float32)
        out[1:] += np.square(rating[x, None] - p).sum(0)
    return out


# ------------------------------------------------------------------ explicit ALS


def solve_positive(df: DataFrame, k: int, a: str = "a", b: str = "b", out: str = "f") -> DataFrame:
    """``df`` with the solution ``out`` (an array) of A x = b for each row: ``a``
    holds the lower triangle of a positive definite matrix row by row, ``b`` the
    right side. Cholesky factors and both substitutions are column expressions,
    one projection for each unknown, so none is worked out twice."""
    kept = [c for c in df.columns if c not in (a, b)]
    L = lambda i, j: F.col(f"_l{i}_{j}")
    for j in range(k):  # column j of the factor
        def left(i, j=j):
            return F.col(a)[i * (i + 1) // 2 + j] - sum((L(i, m) * L(j, m) for m in range(j)), F.lit(0.0))

        df = df.withColumn(f"_l{j}_{j}", F.sqrt(left(j)))
        df = df.withColumns({f"_l{i}_{j}": left(i) / L(j, j) for i in range(j + 1, k)}) if j + 1 < k else df
    for i in range(k):
        df = df.withColumn(f"_y{i}", (F.col(b)[i] - sum((L(i, m) * F.col(f"_y{m}") for m in range(i)), F.lit(0.0))) / L(i, i))
    for i in reversed(range(k)):
        df = df.withColumn(f"_x{i}", (F.col(f"_y{i}") - sum((L(m, i) * F.col(f"_x{m}") for m in range(i + 1, k)), F.lit(0.0))) / L(i, i))
    return df.select(*kept, F.array(*[F.col(f"_x{i}") for i in range(k)]).alias(out))


def explicit_half_step(ratings: DataFrame, fixed: DataFrame, fixed_key: str, solve_key: str, rank: int, reg: float) -> DataFrame:
    """Least squares of every ``solve_key`` against the fixed side (R9): the
    normal equations of a key are sums over its ratings, added up before the
    shuffle; the penalty is ``reg`` times the number of its ratings, as Spark
    ML has it. Returns (solve_key, f)."""
    j = ratings.join(fixed.select(F.col(fixed_key), F.col("f")), fixed_key)
    pairs = [(i, m) for i in range(rank) for m in range(i + 1)]
    lower = [F.sum(F.col("f")[i] * F.col("f")[m]).alias(f"_a{i}_{m}") for i, m in pairs]
    right = [F.sum(F.col("f")[i] * F.col("rating")).alias(f"_b{i}") for i in range(rank)]
    s = j.groupBy(solve_key).agg(*lower, *right, F.count(F.lit(1)).alias("_n"))
    ridge = F.lit(float(reg)) * F.col("_n")
    a = [F.col(f"_a{i}_{m}") + (ridge if i == m else F.lit(0.0)) for i, m in pairs]
    b = [F.col(f"_b{i}") for i in range(rank)]
    return solve_positive(s.select(solve_key, F.array(*a).alias("a"), F.array(*b).alias("b")), rank)


def explicit_als_path(ratings: DataFrame, rank: int, iterations: int, reg: float, seed: int = 3, user="user_id", item="item_id",
                      items: DataFrame | None = None):
    """Yields (iteration, user factors, item factors) of explicit ALS on the
    rated cells alone, users solved first, from a start that is a function of
    the item (or from ``items``: item, f). Factors are written after every half
    step."""
    r = written(ratings.select(F.col(user).alias("u"), F.col(item).alias("i"), F.col("rating").cast("double").alias("rating")), "ratings")
    items = init_factors(r.select("i").distinct(), "i", rank, seed) if items is None else items.select(F.col(item).alias("i"), "f")
    for it in range(1, iterations + 1):
        users = written(explicit_half_step(r, items, "i", "u", rank, reg), "factors")
        items = written(explicit_half_step(r, users, "u", "i", rank, reg), "factors")
        yield it, users.select(F.col("u").alias(user), "f"), items.select(F.col("i").alias(item), "f")


def explicit_predict(cells: DataFrame, users: DataFrame, items: DataFrame, user="user_id", item="item_id") -> DataFrame:
    """``cells`` whose user and item both have factors, with ``prediction`` (R10);
    cells of others are left out, as with Spark ML's "drop"."""
    j = cells.join(users.select(user, F.col("f").alias("fu")), user).join(items.select(item, F.col("f").alias("fi")), item)
    return j.withColumn("prediction", dot(F.col("fu"), F.col("fi"))).drop("fu", "fi")
