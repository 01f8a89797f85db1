"""Mixing sources to target weights by Sainte-Lague apportionment (DataFrame functions only).

1. Sizes: words of each document, summed by source.
2. Targets: every source gets its weight's share of the wanted total, but at
   most ``max_repeat`` times its size; what is above is shared again by weight.
   Sorted by cap over weight the capped sources are a prefix, so one pass of
   running sums settles it.
3. Seats: the total is cut into blocks of ``block_words`` words, and the blocks
   go one by one to the source with the highest quotient target / (2k + 1),
   k being the blocks it has. Only quotients near the last seat are formed:
   all higher ones win, whatever the order.
4. Quotas: a source's blocks go to its shards in the same way, by shard size.
   A source has about sqrt(documents) shards, so neither a hot source nor a
   shard is ever more than that many rows in one task.
5. Words: a shard holds at most ``max_repeat`` times its words. What its blocks are above that goes on
   to the source's next shards with room, in their order, and so does one partial block: a
   source takes its target to the word (rounded), however small it or its shards are.
6. Selection: a shard lays its documents on a ring in seeded order and takes
   its words, consecutive blocks, from a seeded start. More words than the
   ring's length go round again, which repeats documents.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order; a null or repeated doc_id is a row like any other; an empty table
gives no rows; a source without words has target 0. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

WORD = r"[^\x20\x09-\x0D]+"


def _hash32(*parts: Column) -> Column:
    """A seeded 32-bit number that other SQL engines can form as well."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("bigint")


def sainte_lague(df: DataFrame, weight: str, seats: str, group: list[str], tie: list[Column]) -> DataFrame:
    """Add ``quota``: the seats of each row, given ``seats`` for its whole group.

    With T the group's weight and n its rows, the row's quota lies between the
    rounded weight * (seats -+ n/2) / T, so all but about n seats are settled
    without forming their quotients, and at most about 4n candidates are ranked.
    """
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    names = df.columns
    half = F.count(F.lit(1)).over(whole) / 2
    total = F.sum(F.col(weight).cast("double")).over(whole)

    def share(seated: Column) -> Column:
        return F.coalesce(F.floor(F.col(weight) * seated / F.nullif(total, F.lit(0.0)) + 0.5), F.lit(0))

    bounds = df.select("*", F.greatest(F.lit(0), share(F.col(seats) - half) - 1).alias("_low"),
                       (share(F.col(seats) + half) + 1).alias("_high"))
    left = bounds.withColumn("_left", F.col(seats) - F.sum("_low").over(whole))
    seat = left.withColumn("_k", F.explode(F.sequence(F.col("_low"), F.col("_high"))))
    best = whole.orderBy((F.col(weight) / (2 * F.col("_k") + 1)).desc(), *tie, "_k")
    won = seat.withColumn("_won", (F.row_number().over(best) <= F.col("_left")) & (F.col(weight) > 0))
    return won.groupBy(*names).agg((F.first("_low") + F.sum(F.col("_won").cast("bigint"))).alias("quota"))


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, max_repeat: int) -> DataFrame:
    """(source, source_size, n_docs, rank, target) from sized documents; one row per source."""
    one = Window.partitionBy(F.lit(0))
    by_code = one.orderBy(F.col("source").isNull(), "source")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = sources.withColumn("rank", F.row_number().over(by_code))
    ranked = ranked.select("*", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")).alias("weight"),
                           (F.col("source_size") * max_repeat).alias("cap"),
                           (F.sum("source_size").over(one) * F.lit(float(share))).alias("wanted"))
    order = one.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    onward = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    capped = ranked.withColumn("full", F.col("cap") * onward <= F.col("weight") * (F.col("wanted") - before))
    held = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(one)
    rest = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(one)
    return capped.withColumn("target", F.when(F.col("full"), F.col("cap").cast("double"))
                             .otherwise(F.col("weight") * ((F.col("wanted") - held) / F.nullif(rest, F.lit(0)))))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, max_repeat: int = 2,
                block_words: int = 8, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """doc_id, size, source, source_size, target, shard, quota (the shard's blocks), words (the shard's), taken."""
    sizes = stored(docs.select(
        docs[id_col].alias("doc_id"), docs[source_col].alias("source"),
        F.coalesce(F.regexp_count(docs[text_col], F.lit(WORD)), F.lit(0)).cast("bigint").alias("size")), "sizes")

    goal = targets(sizes, weights, share, max_repeat)
    seats = F.floor(F.col("wanted") / block_words + 0.5).cast("bigint")
    sources = sainte_lague(goal.select("source", "source_size", "n_docs", "rank", "target", seats.alias("seats")),
                           "target", "seats", [], [F.col("rank")])
    sources = stored(sources.select(F.col("source").alias("of"), "source_size", "target", F.col("quota").alias("blocks"),
                                    F.coalesce(F.floor(F.col("target") + 0.5), F.lit(0)).cast("bigint").alias("wanted"),
                                    F.ceil(F.sqrt("n_docs")).cast("bigint").alias("n_shards")), "sources")

    seeded = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    dealt = sizes.join(sources, sizes["source"].eqNullSafe(sources["of"])).drop("of").select(
        "*", F.md5(F.concat_ws(":", F.lit(seed), seeded)).alias("key"),
        (_hash32(F.lit(seed), seeded) % F.col("n_shards")).alias("shard"))

    shards = dealt.groupBy("source", "shard").agg(F.sum("size").alias("ring"), F.first("blocks").alias("blocks"), F.first("wanted").alias("wanted"))
    quotas = sainte_lague(shards, "ring", "blocks", ["source"], [F.col("shard")])
    room = F.col("ring") * max_repeat
    held = quotas.withColumn("held", F.least(F.col("quota") * block_words, room))
    whole, ahead = Window.partitionBy("source"), Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumns({"lacking": F.col("wanted") - F.sum("held").over(whole),      # below 0: the blocks are too many
                             "room_before": F.coalesce(F.sum(room - F.col("held")).over(ahead), F.lit(0)),
                             "held_before": F.coalesce(F.sum("held").over(ahead), F.lit(0))})
    more = F.least(room - F.col("held"), F.greatest(F.lit(0), F.col("lacking") - F.col("room_before")))
    less = F.least(F.col("held"), F.greatest(F.lit(0), -F.col("lacking") - F.col("held_before")))
    quotas = held.select(F.col("source").alias("of"), F.col("shard").alias("at"), "ring", "quota", (F.col("held") + more - less).alias("words"))

    line = Window.partitionBy("source", "shard").orderBy("key", "doc_id", "size")
    placed = dealt.withColumn("stop", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    ring, words = F.nullif(F.col("ring"), F.lit(0)), F.col("words")
    joined = placed.join(quotas, placed["source"].eqNullSafe(F.col("of")) & (placed["shard"] == F.col("at"))).select(
        "*", (F.col("stop") - F.col("size")).alias("begin"), F.floor(words / ring).alias("turns"), (words % ring).alias("part"),
        (_hash32(F.lit(seed), F.coalesce("source", F.lit("")), F.col("shard").cast("string")) % ring).alias("from"))

    def overlap(lo: Column, hi: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("stop"), hi) - F.greatest(F.col("begin"), lo))

    until = F.col("from") + F.col("part")
    taken = F.col("turns") * F.col("size") + overlap(F.col("from"), until) + overlap(F.lit(0), until - F.col("ring"))
    return joined.select("doc_id", "size", "source", "source_size", "target", "shard", "quota", "words",
                         F.coalesce(taken, F.lit(0)).cast("bigint").alias("taken"))


ORACLE_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM sizes GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM per_source
), weighted AS (
  SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT] AS weight, source_size * 2 AS cap,
         (sum(source_size) OVER ())::DOUBLE * 1.5 AS wanted, count(*) OVER () / 2.0::DOUBLE AS half FROM ranked
), running AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS before,
         sum(weight) OVER (ORDER BY cap::DOUBLE / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS onward FROM weighted
), capped AS (
  SELECT *, cap::DOUBLE * onward <= weight * (wanted - before) AS is_full FROM running
), held AS (
  SELECT *, (sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())::DOUBLE AS held,
         (sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ())::DOUBLE AS rest FROM capped
), goal AS (
  SELECT *, CASE WHEN is_full THEN cap::DOUBLE ELSE weight * ((wanted - held) / nullif(rest, 0)) END AS target,
         floor(wanted / 8 + 0.5)::BIGINT AS seats FROM held
), bounds AS (
  SELECT *, greatest(0, coalesce(floor(target * (seats - half) / nullif(sum(target) OVER (), 0) + 0.5), 0)::BIGINT - 1) AS low,
         coalesce(floor(target * (seats + half) / nullif(sum(target) OVER (), 0) + 0.5), 0)::BIGINT + 1 AS high FROM goal
), leftover AS (
  SELECT *, seats - sum(low) OVER () AS seats_left FROM bounds
), seat AS (
  SELECT *, unnest(range(low, high + 1)) AS k FROM leftover
), seat_rank AS (
  SELECT *, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, rank, k) AS place FROM seat
), sources AS (
  SELECT source, source_size, n_docs, target, min(low) + count(*) FILTER (place <= seats_left AND target > 0) AS blocks,
         coalesce(floor(target + 0.5), 0)::BIGINT AS words_wanted, ceil(sqrt(n_docs))::BIGINT AS n_shards FROM seat_rank GROUP BY source, source_size, n_docs, target
), dealt AS (
  SELECT s.*, source_size, target, blocks, words_wanted, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % n_shards AS shard
  FROM sizes s JOIN sources o ON s.source IS NOT DISTINCT FROM o.source
), shards AS (
  SELECT source, shard, sum(size)::BIGINT AS ring, min(blocks) AS blocks, min(words_wanted) AS words_wanted FROM dealt GROUP BY source, shard
), shard_bounds AS (
  SELECT *, greatest(0, coalesce(floor(ring * (blocks - (count(*) OVER w) / 2.0::DOUBLE) / nullif((sum(ring) OVER w)::DOUBLE, 0) + 0.5), 0)::BIGINT - 1) AS low,
         coalesce(floor(ring * (blocks + (count(*) OVER w) / 2.0::DOUBLE) / nullif((sum(ring) OVER w)::DOUBLE, 0) + 0.5), 0)::BIGINT + 1 AS high
  FROM shards WINDOW w AS (PARTITION BY source)
), shard_left AS (
  SELECT *, blocks - sum(low) OVER (PARTITION BY source) AS seats_left FROM shard_bounds
), shard_seat AS (
  SELECT *, unnest(range(low, high + 1)) AS k FROM shard_left
), shard_rank AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY ring::DOUBLE / (2 * k + 1) DESC, shard, k) AS place FROM shard_seat
), block_quotas AS (
  SELECT source, shard, ring, words_wanted, least((min(low) + count(*) FILTER (place <= seats_left AND ring > 0)) * 8, ring * 2)::BIGINT AS words_held
  FROM shard_rank GROUP BY source, shard, ring, words_wanted
), handed AS (
  SELECT *, words_wanted - sum(words_held) OVER (PARTITION BY source) AS lacking,
         coalesce(sum(ring * 2 - words_held) OVER ahead, 0) AS room_before, coalesce(sum(words_held) OVER ahead, 0) AS held_before
  FROM block_quotas WINDOW ahead AS (PARTITION BY source ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), quotas AS (
  SELECT source, shard, ring, (words_held + least(ring * 2 - words_held, greatest(0, lacking - room_before))
         - least(words_held, greatest(0, -lacking - held_before)))::BIGINT AS words FROM handed
), placed AS (
  SELECT *, (sum(size) OVER (PARTITION BY source, shard ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS stop FROM dealt
), joined AS (
  SELECT p.*, q.ring, stop - size AS start, words // nullif(ring, 0) AS turns, words % nullif(ring, 0) AS part,
         ('0x' || substr(md5('mix:' || coalesce(p.source, '') || ':' || p.shard::VARCHAR), 1, 8))::BIGINT % nullif(ring, 0) AS origin
  FROM placed p JOIN quotas q ON p.source IS NOT DISTINCT FROM q.source AND p.shard = q.shard
)
SELECT doc_id, size, source_size, target,
  coalesce(turns * size + greatest(0, least(stop, origin + part) - greatest(start, origin))
           + greatest(0, least(stop, origin + part - ring) - start), 0)::BIGINT AS taken
FROM joined
"""
