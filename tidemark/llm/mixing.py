"""Mixing sources to target weights by a min-cost flow over membership patterns.

Documents with the same set of sources are one node, so the flow network follows the number of different sets.
A pattern offers its words once at cost 0, a second time at cost 1, a third time at cost 2, to each of its sources;
a source takes up to its quota. The flow says how many words of each pattern are taken, and seeded order which.
"""

from __future__ import annotations

import math
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
SEED = "tidemark-mix"
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
#: Different membership patterns the driver's flow network may have; above it the call raises an error.
MAX_PATTERNS = 500_000


def min_cost_flow(offers: list[tuple[int, list[int]]], quotas: list[int], repeats: int = MAX_REPEATS) -> list[dict[int, int]]:
    """Words each pattern sends to each source. offers: (words, sources of the pattern).

    Phases of least cost: shortest distances by the residual costs, then blocking flows over the arcs on
    shortest paths. Costs are small whole numbers, so phases are few and each saturates many arcs.
    """
    n, m = len(offers), len(quotas)
    source, sink = n + m, n + m + 1
    head, room, cost, arcs = [], [], [], [[] for _ in range(n + m + 2)]

    def arc(a: int, b: int, capacity: int, price: int) -> int:
        for x, y, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            arcs[x].append(len(head))
            head.append(y)
            room.append(c)
            cost.append(p)
        return len(head) - 2

    reach = []
    for i, (words, members) in enumerate(offers):
        for tier in range(repeats):
            arc(source, i, words, tier)
        reach.append({s: arc(i, n + s, repeats * words, 0) for s in members})
    for s, quota in enumerate(quotas):
        arc(n + s, sink, quota, 0)

    while True:
        distance = [math.inf] * (n + m + 2)
        distance[source] = 0
        queue, waiting = deque([source]), [False] * (n + m + 2)
        while queue:
            x = queue.popleft()
            waiting[x] = False
            for e in arcs[x]:
                if room[e] and distance[x] + cost[e] < distance[head[e]]:
                    distance[head[e]] = distance[x] + cost[e]
                    if not waiting[head[e]]:
                        waiting[head[e]] = True
                        queue.append(head[e])
        if distance[sink] == math.inf:
            return [{s: room[e ^ 1] for s, e in own.items() if room[e ^ 1]} for own in reach]
        while True:  # blocking flows over shortest arcs, by layers of hops so that zero-cost cycles cannot turn
            layer = [-1] * (n + m + 2)
            layer[source] = 0
            queue = deque([source])
            while queue:
                x = queue.popleft()
                for e in arcs[x]:
                    y = head[e]
                    if room[e] and layer[y] < 0 and distance[x] + cost[e] == distance[y]:
                        layer[y] = layer[x] + 1
                        queue.append(y)
            if layer[sink] < 0:
                break
            turn = [0] * (n + m + 2)
            path: list[int] = []
            x = source
            while True:
                if x == sink:
                    pushed = min(room[e] for e in path)
                    for e in path:
                        room[e] -= pushed
                        room[e ^ 1] += pushed
                    path, x = [], source
                    continue
                while turn[x] < len(arcs[x]):
                    e = arcs[x][turn[x]]
                    if room[e] and layer[head[e]] == layer[x] + 1 and distance[x] + cost[e] == distance[head[e]]:
                        break
                    turn[x] += 1
                if turn[x] < len(arcs[x]):
                    path.append(arcs[x][turn[x]])
                    x = head[path[-1]]
                elif not path:
                    break
                else:
                    layer[x] = -1
                    x = head[path.pop() ^ 1]


def fill_targets(sizes: list[int], weights: list[int], repeats: int = MAX_REPEATS) -> list[float]:
    """Shares of all words by weight; a target stops at ``repeats`` times its size and its excess goes to the others."""
    total, targets = sum(sizes), [0.0] * len(sizes)
    if not total:
        return targets
    order = sorted(range(len(sizes)), key=lambda i: (repeats * sizes[i] / weights[i], i))
    left, weight = total, sum(weights)
    for place, i in enumerate(order):
        if left * weights[i] <= repeats * sizes[i] * weight:
            for j in order[place:]:
                targets[j] = left * weights[j] / weight
            break
        targets[i] = float(repeats * sizes[i])
        left -= repeats * sizes[i]
        weight -= weights[i]
    return targets


def _names(n: int) -> tuple[str, ...]:
    return tuple(f"__{x}{n}" for x in ("size", "sources", "key", "pattern"))


def mix(docs: DataFrame, sources, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """``docs`` (doc_id, text, ...) with size and taken added, and (source, source_size, target) for every source.

    ``sources``: array column of the document's sources; a NULL in it is a source of its own, an empty or NULL array is
    no source and nothing of the document is taken. Sources in code-point order, NULL last, get ``weights`` in turn.
    A pattern's flow is met by whole rounds over all its documents and, for what is left, by documents in the order of a
    seeded hash; the one at the cut gives a part, so each source's words meet its whole-number target. Rows
    that repeat a doc_id stand together in that order and share a cut by size. No text: size 0, nothing taken.
    """
    spark = docs.sparkSession
    size, members, key, pattern = _names(len(docs.columns))
    rows = docs.withColumns({
        size: F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long"),
        members: F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>")))),
        key: F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")),
    })
    sized = materialize(rows.select(F.col(size).alias("size"), F.col(members).alias("sources"), F.col(key).alias("key")), "sizes")
    patterns = sized.groupBy("sources").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    patterns = patterns.orderBy("sources").limit(MAX_PATTERNS + 1).collect()
    if len(patterns) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns; group the sources first")
    names = sorted({s for p in patterns for s in p.sources}, key=lambda s: (s is None, (s or "").encode()))
    place = {s: i for i, s in enumerate(names)}
    by_source = [0] * len(names)
    for p in patterns:
        for s in p.sources:
            by_source[place[s]] += p.words
    targets = fill_targets(by_source, [weights[i % len(weights)] for i in range(len(names))])
    quotas = [math.floor(t) for t in targets]
    flows = min_cost_flow([(p.words, [place[s] for s in p.sources]) for p in patterns], quotas)
    counted = sum(p.docs for p in patterns)
    plan = []
    for i, (p, flow) in enumerate(zip(patterns, flows, strict=True)):
        whole, rest = divmod(sum(flow.values()), p.words) if p.words else (0, 0)
        plan.append((p.sources, i, whole, rest))
    plan = spark.createDataFrame(plan, "sources array<string>, pattern int, whole long, rest long")
    same = lambda a, b: a.eqNullSafe(b)

    # the cut of each pattern: words before each range of the hash, then the documents of one range in order
    digits = max(2, math.ceil(math.log(max(counted, 1) / 100_000 + 1, 16)))
    named = sized.withColumnRenamed("sources", "own")
    known = named.join(plan.where("rest > 0"), same(F.col("own"), F.col("sources"))).select("pattern", "rest", "key", "size")
    ranges = known.groupBy("pattern", F.substring("key", 1, digits).alias("range")).agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    ranges.createOrReplaceTempView("__mix_ranges")
    cut = spark.sql("""
        SELECT pattern, range, upto - words AS before FROM (
          SELECT *, sum(words) OVER (PARTITION BY pattern ORDER BY range) AS upto FROM __mix_ranges)
        WHERE upto >= rest AND upto - words < rest""")
    spark.catalog.dropTempView("__mix_ranges")
    cut = materialize(cut, "cut-ranges")
    inside = known.withColumn("range", F.substring("key", 1, digits)).join(cut, ["pattern", "range"])
    groups = inside.groupBy("pattern", "rest", "before", "key").agg(F.sum("size").alias("words"))
    groups.createOrReplaceTempView("__mix_groups")
    ends = spark.sql("""
        SELECT pattern, key AS cut_key, words AS cut_size, rest - (upto - words) AS cut_words FROM (
          SELECT *, before + sum(words) OVER (PARTITION BY pattern ORDER BY key) AS upto FROM __mix_groups)
        WHERE upto >= rest AND upto - words < rest""")
    spark.catalog.dropTempView("__mix_groups")
    ends = materialize(ends, "cuts")

    full = plan.join(ends, "pattern", "left").select(F.col("sources").alias(pattern), "whole", "cut_key", "cut_size", "cut_words")
    joined = rows.join(full, same(rows[members], F.col(pattern)), "left")
    extra = F.when(F.col("cut_key").isNull() | (F.col(key) > F.col("cut_key")), F.lit(0))
    extra = extra.when(F.col(key) < F.col("cut_key"), F.col(size)).otherwise(F.floor(F.col("cut_words") * F.col(size) / F.col("cut_size")).cast("long"))
    taken = F.col("whole") * F.col(size) + extra
    shares = spark.createDataFrame(
        [(s, by_source[i], targets[i]) for i, s in enumerate(names)], "source string, source_size long, target double"
    )
    plain = [c for c in docs.columns if c.lower() not in ("size", "taken")]
    return joined.select(*plain, F.col(size).alias("size"), taken.cast("long").alias("taken")), shares


def mixed_by_source(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, source, ...) with size, source_size, target and taken; see ``mix``.

    Each document has its one source; columns of ``docs`` that bear these names are replaced.
    """
    clash = ("source_size", "target", "size", "taken")
    docs = docs.select(*[c for c in docs.columns if c.lower() not in clash])
    taken, shares = mix(docs, F.array(F.col("source").cast("string")))
    shares = shares.withColumnRenamed("source", "__source")
    own = taken.join(shares, F.col("source").cast("string").eqNullSafe(F.col("__source")), "left")
    return own.select(*docs.columns, "size", "source_size", "target", "taken")


#: The same for one source per document, as SQL.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(concat('tidemark-mix:', coalesce(cast(doc_id AS varchar), ''))) AS k
  FROM {docs}),
s AS (SELECT source, cast(sum(size) AS bigint) AS sz FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w,
             row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM s),
o AS (SELECT *, cast(sum(sz) OVER () AS bigint) AS total, row_number() OVER (ORDER BY 3 * sz / w, rn) AS place FROM w),
c AS (SELECT *, total - coalesce(sum(3 * sz) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_words,
             sum(w) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_w FROM o),
f AS (SELECT min(place) AS first_open FROM c WHERE rest_words * w <= 3 * sz * rest_w),
g AS (SELECT rest_words AS open_words, rest_w AS open_w, place AS open_place FROM c, f WHERE place = first_open),
t AS (SELECT source, sz, CASE WHEN total = 0 THEN 0.0 WHEN place < open_place THEN cast(3 * sz AS double)
             ELSE cast(open_words * w AS double) / cast(open_w AS double) END AS target FROM c, g),
q AS (SELECT *, cast(floor(target) AS bigint) AS quota FROM t),
p AS (SELECT *, CASE WHEN sz = 0 THEN 0 ELSE quota // sz END AS whole, CASE WHEN sz = 0 THEN 0 ELSE quota % sz END AS rest FROM q),
k AS (SELECT source, k, cast(sum(size) AS bigint) AS gsize FROM d GROUP BY source, k),
u AS (SELECT *, cast(sum(gsize) OVER (PARTITION BY source ORDER BY k) AS bigint) AS upto FROM k)
SELECT {columns}, d.size AS size, p.sz AS source_size, p.target AS target,
       cast(p.whole * d.size + CASE WHEN u.upto <= p.rest THEN d.size WHEN u.upto - u.gsize >= p.rest THEN 0
            ELSE floor((p.rest - (u.upto - u.gsize)) * d.size / u.gsize) END AS bigint) AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
JOIN u ON u.source IS NOT DISTINCT FROM d.source AND u.k = d.k
"""
