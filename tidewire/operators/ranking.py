"""Scores, total order, capped shortlist and candidate pairs of events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.categories import Profile
from ..functions.entities import DECISIVE_WEIGHT, has_conflicting_version, strongest_shared, weight, weighted_overlap
from ..functions.text import identity_signature, title_similarity
from .lineage import checked, lookup, stored

# Shares of the score, the shortlist's and the pairs' limits.
CREDIBILITY_SHARE = NOVELTY_SHARE = PERSONAL_SHARE = 0.15
TECHNICAL_SHARE, INDUSTRY_SHARE, DEVELOPER_SHARE = 0.20, 0.15, 0.20
SHORTLIST, PER_CATEGORY = 20, 4
PAIR_FLOOR, PAIR_ENTITY_SHARE, PAIR_WORDING, PAIR_ENTITIES, PAIRS = 0.12, 0.5, 0.35, 2, 5
MERGE_CONFIDENCE = 0.70


def clamp(value: Column) -> Column:
    return F.round(F.least(F.lit(10.0), F.greatest(F.lit(0.0), value)), 3)


def credibility(source_ids: Column, best: Column) -> Column:
    """Seven times the best source's credibility and one for each further source, at most three."""
    more = F.least(F.size(source_ids) - 1, F.lit(3))
    return F.when(F.size(source_ids) > 0, clamp(7.0 * best + more)).otherwise(F.lit(0.0))


def best_credibility(source_ids: Column, registry: dict[str, float] | Column, default: float = 0.5) -> Column:
    """The largest credibility of a list of sources; unknown ones count as ``default``."""
    table = registry if isinstance(registry, Column) else F.create_map(*[F.lit(x) for kv in registry.items() for x in kv]) if registry else F.create_map(F.lit(""), F.lit(default))
    return F.array_max(F.transform(source_ids, lambda s: F.coalesce(F.try_element_at(table, s), F.lit(default))))


def novelty(first_seen: Column, today: Column, n_specific: Column, n_unseen: Column) -> Column:
    """Six for a new event, else three, and up to four for the share of specific entities not seen lately."""
    base = F.when(F.to_date(first_seen) >= today, 6.0).otherwise(3.0)
    return clamp(base + F.when(n_specific > 0, 4.0 * n_unseen / n_specific).otherwise(1.0))


def specific_entities(entities: Column) -> Column:
    return F.filter(entities, lambda e: weight(e) >= DECISIVE_WEIGHT - 0.4)


def with_unseen(events: DataFrame, seen: DataFrame, key: str = "id") -> DataFrame:
    """``events`` with n_specific and n_unseen; ``seen`` (entity) may be of any size: it is joined, not shipped."""
    specific = events.select(key, F.explode(specific_entities(F.col("entities"))).alias("entity"))
    marked = specific.join(seen.select("entity").distinct().withColumn("seen", F.lit(True)), "entity", "left")
    counts = marked.groupBy(key).agg(F.count(F.lit(1)).alias("n_specific"), F.count_if(F.col("seen").isNull()).alias("n_unseen"))
    return events.join(counts, key, "left").fillna(0, ["n_specific", "n_unseen"])


def relevance(title: Column, entities: Column, category: Column, profile: Profile) -> Column:
    text = F.concat_ws(" ", title, F.array_join(entities, " "))
    interest = F.least(profile.hits(text, profile.interests), F.lit(2))
    low = F.least(profile.hits(text, profile.low_interest), F.lit(2))
    return clamp(6.0 * profile.weight_for(category) + 2.0 * interest - 2.0 * low)


def deterministic(cred: Column, nov: Column, personal: Column) -> Column:
    shares = CREDIBILITY_SHARE + NOVELTY_SHARE + PERSONAL_SHARE
    return F.round((cred * CREDIBILITY_SHARE + nov * NOVELTY_SHARE + personal * PERSONAL_SHARE) / shares, 3)


def full_score(cred: Column, nov: Column, personal: Column, technical: Column, industry: Column, developer: Column) -> Column:
    """All six parts where a model has judged the impact, else the deterministic half."""
    own = cred * CREDIBILITY_SHARE + nov * NOVELTY_SHARE + personal * PERSONAL_SHARE
    judged = F.round(own + technical * TECHNICAL_SHARE + industry * INDUSTRY_SHARE + developer * DEVELOPER_SHARE, 3)
    return F.when(technical.isNull(), deterministic(cred, nov, personal)).otherwise(judged)


def score_events(events: DataFrame, profile: Profile, registry: dict[str, float], today: Column, seen: DataFrame) -> DataFrame:
    """``events`` with credibility, novelty, personal_relevance, score and source_count."""
    wide = with_unseen(events, seen)
    wide = wide.withColumns({
        "credibility": credibility(F.col("source_ids"), best_credibility(F.col("source_ids"), registry)),
        "novelty": novelty(F.col("first_seen"), today, F.col("n_specific"), F.col("n_unseen")),
        "personal_relevance": relevance(F.col("canonical_title"), F.col("entities"), F.col("category"), profile),
        "source_count": F.size("source_ids"),
    })
    return wide.withColumn("score", deterministic(F.col("credibility"), F.col("novelty"), F.col("personal_relevance"))).drop("n_specific", "n_unseen")


def total_order() -> list[Column]:
    """Best score first, then more sources, then later updates, then the id."""
    return [F.desc("score"), F.desc("source_count"), F.desc("last_updated"), F.asc("id")]


def capped_top(df: DataFrame, group: str, order: Sequence[Column], limit: int = SHORTLIST, cap: int = PER_CATEGORY, exempt: Column | None = None) -> DataFrame:
    """At most ``limit`` rows, at most ``cap`` of a group unless exempt, places left over filled by rank; with ``rank``.

    Exempt rows count towards their group's cap.  Only the first max(``limit``, ``cap``) exempt and other rows of a group
    can be chosen or push another over its cap; each task keeps its own such rows before anything is shuffled, so neither
    a hot group nor the final sort grows with the input.
    """
    free = F.coalesce(exempt, F.lit(False)) if exempt is not None else F.lit(False)
    of_kind = F.row_number().over(W.partitionBy(group, "__free").orderBy(*order))
    some = df.withColumn("__free", free).withColumn("__of_kind", of_kind).where(F.col("__of_kind") <= max(limit, cap)).drop("__of_kind")
    place = F.row_number().over(W.partitionBy(group).orderBy(*order))
    ranked = some.withColumn("__place", place).withColumn("__rank", F.row_number().over(W.orderBy(*order)))
    passes = F.col("__free") | (F.col("__place") <= cap)
    chosen = ranked.withColumn("__pass", passes).orderBy(F.desc("__pass"), "__rank").limit(limit)
    return chosen.withColumn("rank", F.row_number().over(W.orderBy("__rank"))).drop("__free", "__place", "__rank", "__pass")


def shortlist(scored: DataFrame, limit: int = SHORTLIST, cap: int = PER_CATEGORY) -> DataFrame:
    return capped_top(scored, "category", total_order(), limit, cap, F.col("source_count") > 1)


def shortlist_stats(scored: DataFrame, limit: int = SHORTLIST, cap: int = PER_CATEGORY) -> DataFrame:
    """One row: considered, selected, corroborated, best and last score, and how many the cap kept out."""
    picked = shortlist(scored, limit, cap)
    best = picked.agg(
        F.count(F.lit(1)).alias("selected"), F.count_if(F.col("source_count") > 1).alias("corroborated"), F.coalesce(F.max("score"), F.lit(0.0)).alias("top_score"), F.coalesce(F.min("score"), F.lit(0.0)).alias("cut_off_score"),
    )
    return scored.agg(F.count(F.lit(1)).alias("considered")).join(best)


def candidate_pairs(events: DataFrame, limit: int = PAIRS, floor: float = PAIR_FLOOR) -> DataFrame:
    """(left_id, right_id, similarity): the pairs of a shortlist that may be one event, most alike first.

    ``events`` has rank, id, canonical_title, category and entities; it is a shortlist, a few dozen rows.
    """
    side = lambda p: events.select(*[F.col(c).alias(f"{p}_{c}") for c in ("rank", "id", "canonical_title", "category", "entities")], identity_signature(F.col("canonical_title")).alias(f"{p}_signature"))
    le, re_ = F.col("l_entities"), F.col("r_entities")
    pairs = side("l").join(side("r"), (F.col("l_category") == F.col("r_category")) & (F.col("l_signature") == F.col("r_signature")) & (F.col("l_rank") < F.col("r_rank")))
    wording = title_similarity(F.col("l_canonical_title"), F.col("r_canonical_title"))
    evidence = (strongest_shared(le, re_) >= DECISIVE_WEIGHT) | (F.size(F.array_intersect(le, re_)) >= PAIR_ENTITIES) | (F.col("wording") >= PAIR_WORDING)
    blend = PAIR_ENTITY_SHARE * weighted_overlap(le, re_) + (1 - PAIR_ENTITY_SHARE) * F.col("wording")
    found = pairs.where(~has_conflicting_version(le, re_)).withColumn("wording", wording).where(evidence).withColumn("blend", blend).where(F.col("blend") >= floor)
    found = found.withColumn("similarity", F.round("blend", 3)).orderBy(F.desc("similarity"), "l_rank", "r_rank").limit(limit)
    return found.select(F.col("l_id").alias("left_id"), F.col("r_id").alias("right_id"), "similarity")


#: About as many members of one set are paired with as many of another's at a time.
BLOCK_ROWS = 500


def overlap_pairs(rows: DataFrame, digits: int | None = None) -> DataFrame:
    """(a, b, overlap, strongest): all pairs a < b of (id, entities) that share an entity, the overlap rounded to ``digits``.

    Rows of an id count as one, with the entities of all; rows without an id or entities have no pairs.  Ids of equal
    entities are one set.  Sets are compared, and a pair of them is spread over its members by blocks: every two blocks
    are a unit of work, which is dealt out with its ids only, so no task's share grows with the size of a set.
    """
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    each = rows.where("id IS NOT NULL").select("id", F.explode("entities").alias("entity"))
    whole = each.groupBy("id").agg(F.array_sort(F.collect_set("entity")).alias("entities"))
    whole = stored(whole.withColumn("set", F.sha2(F.to_json(F.struct("entities")), 256)), "members")
    sets = whole.groupBy("set").agg(F.any_value("entities").alias("entities"), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    sets = stored(sets, "sets")
    placed = lookup(whole.select("id", "set"), sets.select("set", "blocks"), "set")
    blocks = placed.groupBy("set", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block")).agg(F.collect_list("id").alias("ids"))
    of = lambda side: sets.select(*[F.col(c).alias(f"{side}_{c}") for c in sets.columns], F.explode("entities").alias("entity"))
    le, re_ = F.col("l_entities"), F.col("r_entities")
    # Each pair of sets once, where their first common entity is.
    met = of("l").join(of("r"), "entity").where((F.col("l_set") <= F.col("r_set")) & (F.col("entity") == F.array_min(F.array_intersect(le, re_))))
    overlap = weighted_overlap(le, re_)
    held = met.select("l_set", "l_blocks", "r_set", "r_blocks", (overlap if digits is None else F.round(overlap, digits)).alias("overlap"), strongest_shared(le, re_).alias("strongest"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    units = held.withColumn("i", every("l_blocks")).withColumn("j", every("r_blocks")).where("l_set < r_set OR i <= j").drop("l_blocks", "r_blocks")
    units = units.join(blocks.toDF("l_set", "i", "x"), ["l_set", "i"]).join(blocks.toDF("r_set", "j", "y"), ["r_set", "j"]).repartition(tasks, "l_set", "i", "r_set", "j")
    same = (F.col("l_set") == F.col("r_set")) & (F.col("i") == F.col("j"))
    pairs = units.select(same.alias("same"), F.explode("x").alias("x"), "y", "overlap", "strongest").select("same", "x", F.explode("y").alias("y"), "overlap", "strongest")
    return pairs.where("NOT same OR x < y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "overlap", "strongest")


def overlap_classes(rows: DataFrame) -> DataFrame:
    """(a, b, overlap, strongest) of (id, entities): the pairs of classes that share an entity, and each class's members.

    Rows of equal entities are a class, named by its smallest id.  Classes are pairs a < b, with an overlap under 1; every
    other member b of a class is one row with its class a and an overlap of 1.  So the rows grow with the members, not
    with their square, and any pair of members has the overlap of its classes.  Rows without entities are in no class.
    """
    rows = rows.select("id", F.array_sort("entities").alias("entities")).where(F.size("entities") > 0)
    rows = stored(rows.withColumn("set", F.sha2(F.to_json(F.struct("entities")), 256)), "sets")
    classes = stored(rows.groupBy("set").agg(F.min("id").alias("class"), F.any_value("entities").alias("entities")), "classes")
    own = classes.select("set", "class", strongest_shared(F.col("entities"), F.col("entities")).alias("strongest"))
    members = lookup(rows.select("id", "set"), own, "set").where("id <> class").select(F.col("class").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("overlap"), "strongest")
    return overlap_pairs(classes.select(F.col("class").alias("id"), "entities")).unionByName(members)


def ranked(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """All ``rows`` with their ``rank`` in ``order``, which leaves no ties.

    Ranges of the order are numbered one by one and the sizes of those before are added; no task gets all rows.
    """
    low = (1 << 33) - 1  # monotonically_increasing_id has a row's place in its partition in the lower 33 bits
    placed = checked(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    placed = placed.withColumns({"__range": F.shiftright("__at", 33), "__at": F.col("__at").bitwiseAND(F.lit(low))})
    before, offsets = 0, []
    for k, n in sorted(tuple(r) for r in placed.groupBy("__range").count().collect()):
        offsets.append((k, before))
        before += n
    ahead = F.broadcast(rows.sparkSession.createDataFrame(offsets, "__range bigint, __before bigint"))  # a row a range
    return placed.join(ahead, "__range").withColumn("rank", F.col("__before") + F.col("__at") + 1).select("rank", *rows.columns)
