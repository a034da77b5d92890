"""Sort / top-k, key joins and vector similarity.

Exact nearest-neighbour search is quadratic by nature; the question is how
to spread it without materialising the pairs.  :func:`top_k_neighbours`
hashes queries into ``QB`` blocks and items into ``IB`` blocks of bounded
size, replicates each query to every item block and each item to every
query block, and co-groups on ``(query block, item block)``.  Each group
holds at most ``MAX_BLOCK`` queries and items or so (bounded memory per task,
whatever the table size), few enough groups that the copies stay a small
multiple of the tables; it scores them by matrix products of bounded pieces in
numpy and emits only its best ``k`` items per query.  A window
partitioned by query then keeps the best ``k`` of the ``k * IB``
candidates.  No pair row is ever emitted, no side passes through the
driver, and both sides are shuffled by a hash of their own key, so a hot
label or a duplicated vector does not concentrate work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.functions.frames import materialize

# The recommender's eight features, in order, and the default
# preference vector used where a user leaves a preference unset.
RECOMMENDER_FEATURES = (
    "indoor",
    "sunlight_full_sun",
    "sunlight_part_sun_part_shade",
    "sunlight_full_shade",
    "drought_tolerant",
    "care_level_encoded",
    "maintenance_encoded",
    "watering_encoded",
)
PREFERENCE_DEFAULTS = {
    "indoor": 1,
    "sunlight_full_sun": 0,
    "sunlight_part_sun_part_shade": 0,
    "sunlight_full_shade": 0,
    "drought_tolerant": 0,
    "care_level_encoded": 1,
    "maintenance_encoded": 1,
    "watering_encoded": 1,
}
# sunlight preference value -> feature it switches on
SUNLIGHT_FEATURE = {
    "full_sun": "sunlight_full_sun",
    "part_sun": "sunlight_part_sun_part_shade",
    "full_shade": "sunlight_full_shade",
}

DEFAULT_BLOCK = 2048
#: Tables of more rows are cut into ``SPREAD`` blocks a side, until these reach ``MAX_BLOCK`` rows.
SPREAD, MAX_BLOCK = 16, 32_768
#: Rows of queries and items scored at once, and pairs measured at once.
QUERY_ROWS, ITEM_ROWS, PAIR_ROWS = 1024, 4096, 100_000


# ---------------------------------------------------------------------------
# T1, J1, J2
# ---------------------------------------------------------------------------
def top_k(df: DataFrame, col: str, n: int, id_col: str) -> DataFrame:
    """The ``n`` rows with the largest ``col``; ties broken by ``id_col``.
    Planned as TakeOrderedAndProject (per-task top-n, then one small merge)."""
    return df.orderBy(F.desc(col), F.asc(id_col)).limit(n)


def attach_by_key(left: DataFrame, right: DataFrame, id_col: str, how: str = "inner",
                  check_unique: bool = True) -> DataFrame:
    """Attach ``right``'s columns to ``left`` by key (in place of
    positional alignment).  With ``check_unique`` a duplicated key on the
    right is an error, found by a count per key (a hash aggregate with a
    map-side partial step, so a hot key is reduced inside each task) before
    the join is planned.  A hot key on the left is split by AQE's skew-join
    handling."""
    if check_unique:
        dup = (right.groupBy(id_col).agg(F.count(F.lit(1)).alias("__n"))
               .where(F.col("__n") > 1).select(id_col).take(1))
        if dup:
            raise ValueError(f"duplicate key in {id_col}: {dup[0][0]!r}")
    return left.join(right, id_col, how)


def not_yet_seen(df: DataFrame, seen: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``seen`` (left anti join)."""
    return df.join(seen.select(id_col), id_col, "left_anti")


# ---------------------------------------------------------------------------
# V1 preference vectors
# ---------------------------------------------------------------------------
def preference_vectors(prefs: DataFrame, id_col: str = "user_id",
                       defaults: Mapping[str, int] | None = None) -> DataFrame:
    """V1: a table of user preferences -> one feature row per user.

    Input columns (each nullable): ``indoor`` bool, ``sunlight`` one of
    full_sun / part_sun / full_shade, ``drought_tolerance`` bool,
    ``care_level``, ``maintenance_level``, ``watering_frequency`` ints.
    Unset preferences take the defaults; an unknown sunlight value switches
    no sunlight feature on.  One projection, no shuffle.
    """
    d = dict(PREFERENCE_DEFAULTS, **(defaults or {}))
    sun = F.col("sunlight")
    exprs = [F.col(id_col),
             F.coalesce(F.col("indoor").cast("int"), F.lit(d["indoor"])).alias("indoor")]
    for value, feat in SUNLIGHT_FEATURE.items():
        exprs.append(F.when(sun == value, F.lit(1)).otherwise(F.lit(d[feat])).alias(feat))
    exprs += [
        F.coalesce(F.col("drought_tolerance").cast("int"), F.lit(d["drought_tolerant"])).alias("drought_tolerant"),
        F.coalesce(F.col("care_level").cast("int"), F.lit(d["care_level_encoded"])).alias("care_level_encoded"),
        F.coalesce(F.col("maintenance_level").cast("int"), F.lit(d["maintenance_encoded"])).alias("maintenance_encoded"),
        F.coalesce(F.col("watering_frequency").cast("int"), F.lit(d["watering_encoded"])).alias("watering_encoded"),
    ]
    return prefs.select(*exprs)


def as_vector(cols) -> Column:
    """Feature columns -> ``array<double>`` (SQL-visible vector)."""
    return F.array(*[F.col(f"`{c}`").cast("double") for c in cols])


# ---------------------------------------------------------------------------
# V2 cosine of given pairs
# ---------------------------------------------------------------------------
def cosine_col(a, b) -> Column:
    """Cosine similarity of two ``array<double>`` columns computed in double
    with built-in higher-order functions (stays in codegen); a zero vector
    scores 0."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    a = F.transform(a, lambda x: x.cast("double"))
    b = F.transform(b, lambda x: x.cast("double"))

    def dot(u, v):
        return F.aggregate(F.zip_with(u, v, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)

    den = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(den > 0, dot(a, b) / den).otherwise(F.lit(0.0))


def cosine_scores(pairs: DataFrame, a: str, b: str, out_col: str = "score") -> DataFrame:
    """V2: cosine of each (query vector, item vector) pair of a DataFrame
    whose pairs come from a key join."""
    return pairs.withColumn(out_col, cosine_col(a, b))


# ---------------------------------------------------------------------------
# V3 / V4 blocked exact top-k
# ---------------------------------------------------------------------------
def _n_blocks(n: int, block: int | None) -> int:
    """Blocks of ``n`` rows; without a given size as many as spread the work,
    so that what is copied grows with the table until blocks are full."""
    if block is None:
        return max(1, min(math.ceil(n / DEFAULT_BLOCK), max(SPREAD, math.ceil(n / MAX_BLOCK))))
    return max(1, int(math.ceil(n / float(block))))


def _block_of(col: str, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(col)), F.lit(n_blocks)).cast("int")


def _numbers(df: DataFrame, col: str) -> Column:
    """A vector column as floats or doubles, as it is if it is one of both."""
    if df.schema[col].dataType.elementType.typeName() in ("float", "double"):
        return F.col(col)
    return F.transform(F.col(col), lambda x: x.cast("double"))


def _matrix(series: pd.Series) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, 0))
    return np.array(series.tolist(), dtype=np.float64)


def _best_of_rows(r: np.ndarray, c: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """Places of the best ``k`` entries of every row, by rank descending, then
    column ascending; rows in order."""
    order = np.lexsort((c, -rank, r))
    rows = r[order]
    first = np.searchsorted(rows, rows)
    return order[np.arange(len(rows)) - first < k]


def _scan(qm: np.ndarray, im: np.ndarray, qid: np.ndarray, iid: np.ndarray, k: int, metric: str, exclude_self: bool,
          decimals: int | None, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, score) of the best ``k`` items of every query; items come
    in ascending order of their ids, ``floor`` is a score that the k-th best is
    known to reach.

    Matrix products of bounded pieces tell which pairs may still be among the
    best; only those are measured, ranked (scores rounded to ``decimals``) and
    merged.  Distances are measured by true differences: the |a|^2 + |b|^2 -
    2ab form cancels for points that are near each other and far from the
    origin, so it only rules out what is too far by more than its error."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    if not len(qm) or not len(im):
        return none
    step = 10.0 ** -decimals if decimals is not None else 0.0
    ranked = (lambda s: np.round(s, decimals)) if decimals is not None else (lambda s: s)
    cosine = metric == "cosine"
    q, it = (_on_sphere(qm), _on_sphere(im)) if cosine else (qm, im)
    q_size, i_size = (q * q).sum(axis=1), (it * it).sum(axis=1)
    beyond = np.full(len(q), -np.inf)  # ranks must be above it
    if floor is not None:
        known = ~np.isnan(floor)
        beyond[known] = ranked(floor[known]) - step if step else np.nextafter(floor[known], -np.inf)
    out = []
    for a in range(0, len(q), QUERY_ROWS):
        some = slice(a, a + QUERY_ROWS)
        low, ids = beyond[some], qid[some]
        r, c, score, rank = none[0], none[1], none[2], none[2]
        for b in range(0, len(it), ITEM_ROWS):
            part = slice(b, b + ITEM_ROWS)
            near, err = q[some] @ it[part].T, 0.0
            if not cosine:  # minus the squared distance, within ``err``
                err = 4 * (q.shape[1] + 4) * np.finfo(float).eps * (q_size[some] + i_size[part].max())
                near *= 2
                near -= q_size[some, None]
                near -= i_size[None, part]
            if exclude_self:
                near[ids[:, None] == iid[None, part]] = -np.inf
            with np.errstate(invalid="ignore"):
                if cosine:
                    cut = low + 0.4 * step
                else:
                    reach = -low - 0.4 * step
                    cut = np.where(reach >= 0, -reach ** 2 - err, np.inf)
                open_ = np.flatnonzero(np.isneginf(low))
                if len(open_):  # the piece's own k-th best bounds what can be among them
                    kk = min(k, near.shape[1])
                    own = -np.partition(-near[open_], kk - 1, axis=1)[:, kk - 1]
                    if cosine:
                        own = own - 2 * step
                    else:
                        wide = err[open_]
                        own = -(np.sqrt(np.maximum(wide - own, 0)) + 2 * step) ** 2 - wide
                    cut[open_] = np.where(np.isnan(own), -np.inf, own)
                new_r, new_c = np.nonzero(~(near < cut[:, None]))
            if not len(new_r):
                continue
            new_c = new_c + b
            if cosine:
                new_s = near[new_r, new_c - b]
            else:
                new_s = np.empty(len(new_r))
                for at in range(0, len(new_r), PAIR_ROWS):
                    few = slice(at, at + PAIR_ROWS)
                    diff = qm[new_r[few] + a] - im[new_c[few]]
                    new_s[few] = -np.sqrt(np.einsum("ij,ij->i", diff, diff))
            new_rank = ranked(new_s)
            with np.errstate(invalid="ignore"):
                ok = np.isfinite(new_rank) & (new_rank > low[new_r])
            if exclude_self:
                ok &= ids[new_r] != iid[new_c]
            if not ok.any():
                continue
            r, c = np.concatenate([r, new_r[ok]]), np.concatenate([c, new_c[ok]])
            score, rank = np.concatenate([score, new_s[ok]]), np.concatenate([rank, new_rank[ok]])
            best = _best_of_rows(r, c, rank, k)
            r, c, score, rank = r[best], c[best], score[best], rank[best]
            last = np.flatnonzero(np.append(r[1:] != r[:-1], True))
            full = last[np.bincount(r)[r[last]] == k]
            low[r[full]] = np.maximum(low[r[full]], rank[full])
        out.append((r + a, c, score))
    return tuple(np.concatenate(x) for x in zip(*out))


_FOUND = "q long, i long, score double"


def _found(qid: np.ndarray, iid: np.ndarray, score: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"q": qid.astype(np.int64), "i": iid.astype(np.int64), "score": score.astype(float)})


def _block_top_k(k: int, metric: str, exclude_self: bool, decimals: int | None):
    """Per (query block, item block) group: best ``k`` items per query."""
    def run(qdf: pd.DataFrame, idf: pd.DataFrame) -> pd.DataFrame:
        if len(qdf) == 0 or len(idf) == 0:
            return _found(np.zeros(0), np.zeros(0), np.zeros(0))
        idf = idf.sort_values("i", kind="stable")
        qid, iid = qdf["q"].to_numpy(np.int64), idf["i"].to_numpy(np.int64)
        r, c, score = _scan(_matrix(qdf["qv"]), _matrix(idf["iv"]), qid, iid, k, metric, exclude_self, decimals)
        return _found(qid[r], iid[c], score)
    return run


def top_k_neighbours(queries: DataFrame, items: DataFrame, q_id: str, q_vec: str,
                     i_id: str, i_vec: str, k: int = 10, metric: str = "cosine",
                     exclude_self: bool = False, tie_decimals: int | None = 9,
                     query_block: int | None = None, item_block: int | None = None) -> DataFrame:
    """Exact top-``k`` items per query: ``(q_id, rank, i_id, score)``.

    ``metric`` is ``cosine`` (score = similarity, zero vector -> 0) or
    ``euclidean`` (score = distance; nearest first).  Ranking is by score
    (rounded to ``tie_decimals`` so mathematically equal scores tie), then
    by ascending item id.  Ids must be integral keys.

    The two counts that size the blocks are the only driver round trip.
    """
    nq, ni = queries.count(), items.count()
    qb, ib = _n_blocks(nq, query_block), _n_blocks(ni, item_block)
    q = (queries.select(F.col(q_id).cast("bigint").alias("q"), _numbers(queries, q_vec).alias("qv"))
         .withColumn("qb", _block_of("q", qb))
         .withColumn("ib", F.explode(F.sequence(F.lit(0), F.lit(ib - 1)))))
    it = (items.select(F.col(i_id).cast("bigint").alias("i"), _numbers(items, i_vec).alias("iv"))
          .withColumn("ib", _block_of("i", ib))
          .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1)))))
    cand = (q.groupBy("qb", "ib").cogroup(it.groupBy("qb", "ib"))
            .applyInPandas(_block_top_k(k, metric, exclude_self, tie_decimals), _FOUND))
    key = F.round("score", tie_decimals) if tie_decimals is not None else F.col("score")
    w = Window.partitionBy("q").orderBy(key.desc(), F.col("i").asc())
    best = cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    score = F.col("score") if metric == "cosine" else -F.col("score")
    return best.select(F.col("q").alias(q_id), "rank", F.col("i").alias(i_id), score.alias("score"))


# ---------------------------------------------------------------------------
# V3 / V4 exact top-k that skips blocks
# ---------------------------------------------------------------------------
#: Pivots at most: they and their partitions' sizes are all that the driver holds.
MAX_PIVOTS = 4096


@dataclass(frozen=True)
class Pivots:
    """Points that partition the items, and of each partition the number of
    items and the least and greatest distance to its pivot.  For ``cosine``
    all vectors are on the unit sphere; items without direction (zero vectors)
    are partition -1."""
    points: np.ndarray
    count: np.ndarray
    near: np.ndarray
    far: np.ndarray
    lost: int
    metric: str

    def prepared(self, v: np.ndarray) -> np.ndarray:
        return _on_sphere(v) if self.metric == "cosine" else v

    def sizes(self) -> np.ndarray:
        """Items of each partition, last those without direction."""
        return np.append(self.count, self.lost).astype(np.int64)

    def distances(self, v: np.ndarray) -> np.ndarray:
        """Of rows of prepared vectors to all pivots."""
        out = np.zeros((len(v), len(self.points)))
        for j in range(v.shape[1] if len(v) else 0):
            diff = v[:, j, None] - self.points[None, :, j]
            out += diff * diff
        return np.sqrt(out)

    def bounds(self, d: np.ndarray) -> np.ndarray:
        """Least distance that an item of each partition can have, from the
        distances to the pivots (triangle inequality)."""
        low = np.maximum(np.maximum(d - self.far, self.near - d), 0.0)
        return np.where(self.count > 0, low, np.inf)


def _on_sphere(v: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(v, axis=1, keepdims=True) if len(v) else np.ones((0, 1))
    return v / np.where(size > 0, size, 1.0)


def _slack(metric: str, decimals: int | None, threshold: np.ndarray) -> np.ndarray:
    """How far beyond the threshold a distance may be and still tie with it
    when scores are rounded."""
    step = 2.0 * 10.0 ** -decimals if decimals is not None else 0.0
    if metric != "cosine":
        return threshold + step + 1e-9 * (1 + threshold)
    return np.sqrt(threshold ** 2 + 2 * step) + 1e-9


def _pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames of so few rows that their distances to all pivots are small."""
    for f in frames:
        for at in range(0, len(f), QUERY_ROWS):
            yield f.iloc[at:at + QUERY_ROWS]


def fit_pivots(items: DataFrame, n: int, metric: str) -> tuple[Pivots, DataFrame]:
    """``n`` items (those with the least hash of the id) as pivots, and the
    items (columns ``i``, ``iv``) with the partition ``part`` of their nearest
    pivot."""
    usable = items.where(F.exists("iv", lambda x: x != 0)) if metric == "cosine" else items
    first = usable.orderBy(F.xxhash64("i", F.lit(3)), "i").limit(min(n, MAX_PIVOTS)).collect()
    points = np.array([r["iv"] for r in first], float) if first else np.zeros((0, 0))
    blank = np.zeros(len(points))
    start = Pivots(_on_sphere(points) if metric == "cosine" and len(points) else points, blank, blank, blank, 0, metric)

    def place(frames):
        for f in _pieces(frames):
            v = _matrix(f["iv"])
            d = start.distances(start.prepared(v)) if len(start.points) else np.zeros((len(f), 1))
            part, at = d.argmin(axis=1) if len(f) else np.zeros(0, int), np.arange(len(f))
            lost = ~v.any(axis=1) if metric == "cosine" and len(f) else np.zeros(len(f), bool)
            yield f.assign(part=np.where(lost, -1, part).astype("int32"), d=np.where(lost, 0.0, d[at, part] if len(f) else 0.0))

    kind = items.schema["iv"].dataType.simpleString()
    placed = materialize(items.mapInPandas(place, f"i long, iv {kind}, part int, d double"))
    count, near, far, lost = np.zeros(len(points)), np.zeros(len(points)), np.zeros(len(points)), 0
    for r in placed.groupBy("part").agg(F.count("*").alias("n"), F.min("d").alias("near"), F.max("d").alias("far")).collect():
        if r["part"] < 0:
            lost = r["n"]
        else:
            count[r["part"]], near[r["part"]], far[r["part"]] = r["n"], r["near"], r["far"]
    return Pivots(start.points, count, near, far, lost, metric), placed


@dataclass(frozen=True)
class Bundles:
    """Partitions laid side by side into bundles of about as many items; a
    larger partition has several bundles of its own, among which its items are
    dealt.  The last partition is that of items without direction."""
    first: np.ndarray   # per partition its (first) bundle
    pieces: np.ndarray  # and how many it has
    members: tuple[np.ndarray, ...]  # per bundle the partitions in it

    def wanted(self, need: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Of a table (query, partition): per bundle the queries that need
        something of it, what they need as bits, and the pairs that are formed
        (those of a partition are counted with its first bundle)."""
        for bundle, parts in enumerate(self.members):
            own = need[:, parts]
            rows = np.flatnonzero(own.any(axis=1))
            if len(rows):
                counted = np.where(self.first[parts] == bundle, sizes[parts], 0)
                yield bundle, rows, np.packbits(own[rows], axis=1), own[rows] @ counted


def bundled(sizes: np.ndarray, most: int) -> Bundles:
    first, pieces, members = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64), []
    held = 0
    for part, n in enumerate(sizes.tolist()):
        pieces[part] = max(1, math.ceil(n / most))
        if not n:
            continue
        if not members or held + n > most:
            members.append([])
            held = 0
        first[part] = len(members) - 1
        members[-1].append(part)
        members += [[part] for _ in range(pieces[part] - 1)]
        held += n
    return Bundles(first, pieces, tuple(np.array(m, np.int64) for m in members))


def _met(wanted: DataFrame, laid: DataFrame, bundles: Bundles, k: int, metric: str, exclude_self: bool,
         decimals: int | None, query_block: int) -> DataFrame:
    """``q``, ``i``, ``score``: the best ``k`` of each (query, bundle) of
    ``wanted`` (``q``, ``qv``, ``kth``, ``bundle``, ``need``) among the items
    of the partitions that it needs.  Many queries of one bundle are cut into
    blocks; a block and a bundle are one group."""
    asked = wanted.groupBy("bundle").agg(F.ceil(F.count("*") / query_block).alias("qb"))
    q = wanted.join(F.broadcast(asked), "bundle").withColumn("qc", F.pmod(F.xxhash64("q", F.lit(7)), F.col("qb")))
    it = (laid.join(F.broadcast(asked), "bundle")
          .select("bundle", "part", "i", "iv", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("qb") - 1)).alias("qc")))

    def run(key, qdf: pd.DataFrame, idf: pd.DataFrame) -> pd.DataFrame:
        if len(qdf) == 0 or len(idf) == 0:
            return _found(np.zeros(0), np.zeros(0), np.zeros(0))
        idf = idf.sort_values("i", kind="stable")
        qm, im, qid, iid = _matrix(qdf["qv"]), _matrix(idf["iv"]), qdf["q"].to_numpy(np.int64), idf["i"].to_numpy(np.int64)
        kth, part = qdf["kth"].to_numpy(dtype=float, na_value=np.nan), idf["part"].to_numpy()
        parts = bundles.members[int(key[0])]
        need = np.unpackbits(np.frombuffer(b"".join(qdf["need"]), np.uint8).reshape(len(qdf), -1), axis=1, count=len(parts))
        held, n = [], 0

        def best() -> tuple[np.ndarray, ...]:
            r, c, score = (np.concatenate(x) for x in zip(*held))
            keep = _best_of_rows(r, c, np.round(score, decimals) if decimals is not None else score, k)
            return r[keep], c[keep], score[keep]

        for j, p in enumerate(parts.tolist()):
            rows, own = np.flatnonzero(need[:, j]), np.flatnonzero(part == p)
            r, c, score = _scan(qm[rows], im[own], qid[rows], iid[own], k, metric, exclude_self, decimals, kth[rows])
            held.append((rows[r], own[c], score))
            n += len(r)
            if n > 1_000_000:
                held = [best()]
                n = 0
        r, c, score = best()
        return _found(qid[r], iid[c], score)

    return (q.select("bundle", "qc", "q", "qv", "kth", "need").groupBy("bundle", "qc")
            .cogroup(it.groupBy("bundle", "qc")).applyInPandas(run, _FOUND))


def top_k_pruned(queries: DataFrame, items: DataFrame, q_id: str, q_vec: str, i_id: str, i_vec: str, k: int = 10,
                 metric: str = "cosine", exclude_self: bool = False, tie_decimals: int | None = 9,
                 query_block: int | None = None, item_block: int | None = None,
                 pivots: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The result of :func:`top_k_neighbours`, without scoring every pair.

    Items are partitioned by their nearest pivot.  A query is first scored
    against its nearest partitions that together hold enough items; its k-th
    best there bounds the k-th best of all.  Of the other partitions it then
    meets only those that the triangle inequality does not rule out (for
    cosine, distances on the unit sphere; a query without direction meets all).
    Partitions travel in bundles: a query is sent once to each bundle that
    holds partitions it needs, with their numbers as bits, so that where
    nothing is ruled out no more is sent than for scoring every pair.
    No candidate is capped or guessed.  Also returns one row ``(queries, items,
    pairs, scored)``: all pairs, and those that were formed.
    """
    q = materialize(queries.select(F.col(q_id).cast("bigint").alias("q"), _numbers(queries, q_vec).alias("qv")))
    it = items.select(F.col(i_id).cast("bigint").alias("i"), _numbers(items, i_vec).alias("iv"))
    nq, n_items = q.count(), it.count()
    index, placed = fit_pivots(it, pivots or max(1, math.ceil(math.sqrt(n_items))), metric)
    sizes, n_points = index.sizes(), len(index.points)
    bundles = bundled(sizes, item_block or math.ceil(n_items / _n_blocks(n_items, None)) or 1)
    query_block = query_block or math.ceil(nq / _n_blocks(nq, None)) or 1
    where = q.sparkSession.createDataFrame([(p if p < n_points else -1, int(b), int(n)) for p, (b, n) in
                                            enumerate(zip(bundles.first, bundles.pieces))], "part int, b long, n long")
    laid = (placed.join(F.broadcast(where), "part")
            .select((F.col("b") + F.pmod(F.xxhash64("i", F.lit(7)), F.col("n"))).alias("bundle"),
                    F.when(F.col("part") < 0, n_points).otherwise(F.col("part")).alias("part"), "i", "iv"))
    enough = k + (1 if exclude_self else 0)

    def measured(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances to the pivots, and the table (query, partition) of the
        first round."""
        d = index.distances(index.prepared(v)) if n_points else np.zeros((len(v), 0))
        need = np.zeros((len(v), n_points + 1), bool)
        if n_points:
            order = np.argsort(d, axis=1, kind="stable")
            before = np.cumsum(index.count[order], axis=1) - index.count[order]
            np.put_along_axis(need, order, before < enough, axis=1)
        return d, need & (sizes > 0)

    def sent(f: pd.DataFrame, need: np.ndarray) -> Iterator[pd.DataFrame]:
        for bundle, rows, bits, formed in bundles.wanted(need, sizes):
            yield f.iloc[rows][["q", "qv", "kth"]].assign(bundle=bundle, need=[b.tobytes() for b in bits], formed=formed)

    def nearest(frames):
        for f in _pieces(frames):
            yield from sent(f.assign(kth=np.nan), measured(_matrix(f["qv"]))[1])

    schema = f"q long, qv {q.schema['qv'].dataType.simpleString()}, kth double, bundle long, need binary, formed long"
    first = materialize(q.mapInPandas(nearest, schema))
    found = materialize(_met(first, laid, bundles, k, metric, exclude_self, tie_decimals, query_block))
    order = Window.partitionBy("q").orderBy(F.desc("score"))
    kth = found.withColumn("r", F.row_number().over(order)).where(F.col("r") == k).select("q", F.col("score").alias("kth"))

    def others(frames):
        for f in _pieces(frames):
            v = _matrix(f["qv"])
            d, done = measured(v)
            kth_score = f["kth"].to_numpy(dtype=float, na_value=np.nan)
            far = np.sqrt(np.maximum(2 - 2 * kth_score, 0)) if metric == "cosine" else -kth_score
            far = np.where(np.isnan(far), np.inf, _slack(metric, tie_decimals, far))
            need = np.zeros_like(done)
            if n_points:
                need[:, :-1] = index.bounds(d) <= far[:, None]
            if metric == "cosine":
                lost = ~v.any(axis=1)
                need |= lost[:, None]
                need[:, -1] = ~(far < math.sqrt(2)) | lost  # zero vectors: similarity 0 with all
            yield from sent(f, need & ~done & (sizes > 0))

    second = materialize(q.join(kth, "q", "left").mapInPandas(others, schema))
    more = _met(second, laid, bundles, k, metric, exclude_self, tie_decimals, query_block)
    key = F.round("score", tie_decimals) if tie_decimals is not None else F.col("score")
    w = Window.partitionBy("q").orderBy(key.desc(), F.col("i").asc())
    best = found.unionByName(more).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    score = F.col("score") if metric == "cosine" else -F.col("score")
    pairs = first.unionByName(second).agg(F.coalesce(F.sum("formed"), F.lit(0)).alias("scored"))
    stats = pairs.select(F.lit(nq).cast("bigint").alias("queries"), F.lit(n_items).cast("bigint").alias("items"),
                         F.lit(nq * n_items).cast("bigint").alias("pairs"), F.col("scored").cast("bigint").alias("scored"))
    return best.select(F.col("q").alias(q_id), "rank", F.col("i").alias(i_id), score.alias("score")), stats


# From this many pairs on, a search that may choose skips partitions.
PRUNE_PAIRS = 2_000_000_000
# Above this many (distinct vector x k) result rows the fan-out join is a
# shuffle join instead of a broadcast.
BROADCAST_RESULT_ROWS = 2_000_000


def recommend(prefs: DataFrame, items: DataFrame, item_id: str, k: int = 10,
              user_id: str = "user_id", features=RECOMMENDER_FEATURES, **kw) -> DataFrame:
    """V3: top-``k`` items per user by cosine of the preference vector (V1)
    and the item's feature vector: ``(user_id, rank, item_id, score)``.

    Preference vectors come from a small domain, so many users share one.
    Each DISTINCT vector is scored once (``top_k_neighbours``) and its
    top-k is fanned out to the users holding it by an equi-join on the
    vector key -- the same result as scoring every user, with work
    proportional to distinct vectors x items.  The key is a 64-bit hash of
    the vector, verified collision-free with one aggregate (on a collision
    the users are scored directly).  The result side is broadcast only when
    its row count (distinct vectors x k) is under ``BROADCAST_RESULT_ROWS``;
    otherwise it is a shuffle join, where AQE splits a hot vector key.
    """
    users = preference_vectors(prefs, user_id).select(user_id, as_vector(features).alias("__uv"))
    its = items.select(item_id, as_vector(features).alias("__iv"))
    keyed = users.withColumn("__vid", F.xxhash64("__uv"))
    vecs = materialize(keyed.select("__vid", "__uv").distinct())  # counted and scored
    stats = vecs.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("__vid").alias("ids")).first()
    if stats["n"] != stats["ids"]:  # hash collision: score every user
        return top_k_neighbours(users, its, user_id, "__uv", item_id, "__iv", k, "cosine", **kw)
    per_vec = top_k_neighbours(vecs, its, "__vid", "__uv", item_id, "__iv", k, "cosine", **kw)
    if stats["n"] * k <= BROADCAST_RESULT_ROWS:
        per_vec = F.broadcast(per_vec)
    return (keyed.select(user_id, "__vid").join(per_vec, "__vid")
            .select(user_id, "rank", item_id, "score"))


def knn_regress(train: DataFrame, query: DataFrame, id_col: str, vec_col: str, target: str,
                k: int = 20, out_col: str = "prediction", prune: bool | None = False, **kw) -> DataFrame:
    """V4: k-nearest-neighbours regression -- the mean ``target`` of the
    ``k`` nearest training rows (euclidean) for each query row.  ``prune``
    skips blocks by pivots (:func:`top_k_pruned`): the same result, worth it for
    large training sets whose vectors form clusters (None: from ``PRUNE_PAIRS``
    pairs on)."""
    if prune is None:
        prune = train.count() * query.count() >= PRUNE_PAIRS
    sides = (query.select(id_col, vec_col), train.select(F.col(id_col).alias("__train_id"), vec_col),
             id_col, vec_col, "__train_id", vec_col, k, "euclidean")
    nn = top_k_pruned(*sides, **kw)[0] if prune else top_k_neighbours(*sides, **kw)
    labels = train.select(F.col(id_col).alias("__train_id"), F.col(target).cast("double").alias("__y"))
    return (nn.join(labels, "__train_id")
            .groupBy(id_col).agg(F.avg("__y").alias(out_col)))
