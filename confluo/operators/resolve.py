"""Entity resolution: link the records of a source to the entities of earlier sources.

A record searches the earlier sources for names that contain all its own name terms. Its score with an entity is the mean,
over the sources holding the entity, of the name score plus a bonus for a close date and a bonus for matching developers,
both only in documents whose name matched. Each record keeps its best five entities, and records and entities are then
matched one to one.

Copies make this quadratic if done record by record, so nothing is: names are compared once per distinct name, and the
bonuses are looked up in four lists, each as fine as the bonus needs:

* ``name``  the smallest entity ids per name signature - covers entities that earn no bonus
* ``devs``  per name signature and developer lists      - covers those that earn a developer bonus only
* ``date``  per name signature and dates                - covers those that earn a date bonus only
* ``both``  per name signature, developer lists and dates

Entities that agree in all a list distinguishes have the same score in it, so five of them (smallest ids first) are all that
can ever be among the best five. An entity's score in a list is never above its true score and equals it in the list of the
bonuses it earns. The best five over the union of the lists are therefore exactly the best five.

Names of several terms are few names' company, so which name signatures they meet is stored. A name of one term can be in any number of
names; its score follows from the signature and the term alone, so such terms are read off the lists themselves: five entities each for the name alone,
and for the bonuses only entities found under the term and developer, the term and time slot, or all three. What they meet is never listed.

The list ``name`` is read first. Its fifth best score under a record's name is a floor: a signature that stays below it even with every bonus of a
list is not looked up there, for any of the record's dates and developers. The fifth best of ``devs`` is a higher floor for ``both``.
Names and signatures are long, so past the comparison of names their digests stand for them.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from confluo.functions.scoring import idf, rounded, tf_part
from confluo.functions.text import STOP_WORDS, keep_numbers
from confluo.session import step_path, step_tables, store_step
from confluo.sources.files import delete, exists

log = logging.getLogger(__name__)

# Candidates per record, date window and bonuses.
CANDIDATES = 5
DATE_WINDOW = timedelta(days=14)
DATE_BONUS = 0.5
DEV_BONUS = 2.0

# Rounds of matching before chains are looked for: records that really displace each other settle in a few.
PLAIN_ROUNDS = 6

_WINDOW_SECONDS = int(DATE_WINDOW.total_seconds())

# The weights of left names of one term are sent to every task up to this size.
_BROADCAST_BYTES = 16 << 20


def _digest(key: Column) -> Column:
    """128 bits of SHA-256, which stand for a long key where rows are shuffled by it."""
    return F.substring(F.unhex(F.sha2(key, 256)), 1, 16)


def _list_key(items: Column) -> Column:
    """Text key of a sorted string list; lengths keep different lists apart."""
    return F.array_join(F.transform(items, lambda x: F.concat(F.length(x).cast("string"), F.lit(":"), x)), "")


def _clean_devs(devs: Column) -> Column:
    present = F.filter(F.coalesce(devs, F.array().cast("array<string>")), lambda d: d.isNotNull())
    return F.array_sort(F.array_distinct(present))


def left_records(records: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Records to link, with the keys their scores depend on. Names without terms have no candidates."""
    terms = F.array_sort(F.array_distinct(keep_numbers("name", stop_words)))
    devs = _clean_devs(F.col("devs"))
    return (
        records.select(F.col("id").alias("left_id"), terms.alias("terms"), devs.alias("devs"), F.col("date"))
        .where(F.size("terms") > 0)
        .withColumn("lkey", F.array_join("terms", " "))
        .withColumn("dkey", _list_key(F.col("devs")))
    )


def right_documents(earlier: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Documents of the earlier sources; a name is the sorted bag of its terms."""
    bag = F.array_sort(keep_numbers("name", stop_words))
    return earlier.select(
        "source", "id", "entity_id", bag.alias("bag"), _clean_devs(F.col("devs")).alias("devs"), F.col("date")
    ).withColumn("rkey", F.array_join("bag", " "))


def _name_statistics(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct names, document frequency per term, and per source the name count and mean length."""
    names = documents.where(F.col("rkey") != "").groupBy("source", "rkey").agg(F.count(F.lit(1)).alias("copies")).withColumn("bag", _bag(F.col("rkey")))
    frequency = (
        names.select("source", "copies", F.explode(F.array_distinct("bag")).alias("term"))
        .groupBy("source", "term")
        .agg(F.sum("copies").alias("df"))
    )
    totals = names.groupBy("source").agg(
        F.sum("copies").alias("n_docs"),
        (F.sum(F.col("copies") * F.size("bag")) / F.sum("copies")).alias("avg_len"),
    )
    return names, frequency, totals


def name_candidates(left: DataFrame, documents: DataFrame, statistics: tuple[DataFrame, DataFrame, DataFrame] | None = None) -> DataFrame:
    """Pairs of distinct names ``(lkey, source, rkey, score)`` where the right one contains every left term.

    Each left name is looked up under its rarest term only and the rest is verified, per source. The score is BM25 over the
    name terms with the statistics of that source.
    """
    names, frequency, totals = statistics or _name_statistics(documents)
    terms = _bag(F.col("lkey"))
    wanted = left.select("lkey").distinct().select(_digest(F.col("lkey")).alias("l"), F.size(terms).alias("n_terms"), F.explode(terms).alias("term"))
    # Sorted by term, the weights of a name spell its key. The totals are one row per source: the registry bounds them.
    weighted = (
        wanted.join(frequency, "term")
        .groupBy("l", "source", "n_terms")
        .agg(F.collect_list(F.struct("term", "df")).alias("weights"), F.min(F.struct("df", "term"))["term"].alias("term"))
        .where(F.size("weights") == F.col("n_terms"))
        .join(F.broadcast(totals), "source")
        .withColumn("weights", F.transform(F.array_sort("weights"), lambda w: F.struct(w["term"], idf(F.col("n_docs"), w["df"]).alias("idf"))))
        .select("source", "term", "avg_len", "weights")
    )
    listed = names.select("source", "rkey", F.explode(F.array_distinct("bag")).alias("term"))
    pairs = weighted.join(listed, ["source", "term"])
    pairs = pairs.where(F.size(F.array_except(F.transform("weights", lambda w: w["term"]), _bag(F.col("rkey")))) == 0).withColumn("bag", _bag(F.col("rkey")))

    def add(total: Column, w: Column) -> Column:
        return total + w["idf"] * _tf_part(F.col("bag"), w["term"], F.col("avg_len"))

    lkey = F.array_join(F.transform("weights", lambda w: w["term"]), " ")
    return pairs.select(lkey.alias("lkey"), "source", "rkey", F.aggregate("weights", F.lit(0.0), add).alias("score"))


def _tf_part(bag: Column, term: Column, avg_len: Column) -> Column:
    return tf_part(F.size(F.filter(bag, lambda t: t == term)), F.size(bag), avg_len)


def _bag(rkey: Column) -> Column:
    """The terms of a name; they hold no blanks."""
    return F.split(rkey, " ")


def one_term_weights(left: DataFrame, statistics: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    """``(lkey, weights)``: for every left name of one term what the term weighs in each source, one entry per source at most."""
    _, frequency, totals = statistics
    wanted = left.where(~F.contains("lkey", F.lit(" "))).select("lkey").distinct()
    return (
        wanted.join(frequency.withColumnRenamed("term", "lkey"), "lkey")
        .join(F.broadcast(totals), "source")
        .groupBy("lkey")
        .agg(F.collect_list(F.struct("source", idf(F.col("n_docs"), F.col("df")).alias("idf"), "avg_len")).alias("weights"))
    )


def _met_by_one_term(listed: DataFrame, weights: DataFrame) -> DataFrame:
    """Entities of a list under each left name of one term: ``(lkey, entity_id, n_sources, base, matched, docs)``, with the documents whose name has it.

    A row of the list meets as many names as it has terms. A term's weights are one row, so adaptive execution can split what a frequent term meets.
    Other columns of the weights stay.
    """
    extra = [c for c in weights.columns if c not in ("lkey", "weights")]
    bags = F.transform("docs", lambda d: _bag(d["rkey"]))
    rows = listed.select("entity_id", "docs", F.explode(F.array_distinct(F.flatten(bags))).alias("lkey")).join(weights, "lkey")
    met = rows.select("lkey", "entity_id", F.size("docs").alias("n_sources"), F.filter("docs", lambda d: F.array_contains(_bag(d["rkey"]), F.col("lkey"))).alias("docs"), "weights", *extra)

    def add(total: Column, d: Column) -> Column:
        w = F.get(F.filter("weights", lambda x: x["source"] == d["source"]), F.lit(0))
        return total + w["idf"] * _tf_part(_bag(d["rkey"]), F.col("lkey"), w["avg_len"])

    return met.select(
        "lkey", "entity_id", "n_sources", F.aggregate("docs", F.lit(0.0), add).alias("base"), F.transform("docs", lambda d: d["source"]).alias("matched"), "docs", *extra
    )


def entity_profiles(documents: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Per entity its documents in registry order, its name signature and its developer and date signatures."""
    shape = F.struct("id", "rkey", "devs", "date")
    per_source = [F.min(F.when(F.col("source") == s, shape)).alias(f"doc_{i}") for i, s in enumerate(sources)]
    docs = F.array(
        *[
            F.when(
                F.col(f"doc_{i}").isNotNull(),
                F.struct(
                    F.lit(s).alias("source"),
                    F.col(f"doc_{i}.rkey").alias("rkey"),
                    F.col(f"doc_{i}.devs").alias("devs"),
                    F.col(f"doc_{i}.date").alias("date"),
                ),
            )
            for i, s in enumerate(sources)
        ]
    )
    grouped = documents.where(F.col("source").isin(*sources)).groupBy("entity_id").agg(*per_source)
    profiles = grouped.select("entity_id", F.filter(docs, lambda d: d.isNotNull()).alias("docs"))
    names = F.transform("docs", lambda d: F.concat(d["source"], F.lit("="), d["rkey"]))
    devs = F.transform("docs", lambda d: _list_key(d["devs"]))
    dates = F.transform("docs", lambda d: F.coalesce(F.unix_micros(d["date"]).cast("string"), F.lit("")))
    return (
        profiles.withColumn("sig", _digest(_list_key(names)))
        .withColumn("sig_devs", _list_key(devs))
        .withColumn("sig_dates", F.array_join(dates, "|"))
    )


def _smallest(profiles: DataFrame, keys: Sequence[str], k: int, place: str = "_place") -> DataFrame:
    """The ``k`` smallest entity ids per key; their places stay if the column is named."""
    order = Window.partitionBy(*keys).orderBy("entity_id")
    return profiles.withColumn(place, F.row_number().over(order)).where(F.col(place) <= k).drop("_place")


def _best(rows: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """Best ``k`` entities per key; a task keeps ``k`` rows of a group before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(rounded(F.col("score")).desc(), F.col("entity_id").asc())
    return rows.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k).drop("_place")


def _matched(source: Column) -> Column:
    return F.array_contains(F.col("matched"), source)


def _devs_met(d: Column) -> Column:
    return F.size(F.array_except(F.col("l_devs"), d["devs"])) == 0


def _date_met(d: Column) -> Column:
    return F.coalesce(F.abs(F.unix_micros(d["date"]) - F.unix_micros(F.col("l_date"))) <= _WINDOW_SECONDS * 1_000_000, F.lit(False))


def _count(test) -> Column:
    return F.size(F.filter("docs", lambda d: _matched(d["source"]) & test(d)))


def _date_slot(date: Column) -> Column:
    return F.floor(F.unix_seconds(date) / F.lit(_WINDOW_SECONDS))


def _near_slots(date: Column) -> Column:
    slot = _date_slot(date)
    return F.explode(F.array(slot - 1, slot, slot + 1))


def record_profiles(left: DataFrame) -> DataFrame:
    """Distinct combinations of all that a record's scores depend on; ``lk`` stands for the name."""
    return left.select(_digest(F.col("lkey")).alias("lk"), "dkey", "devs", "date").distinct()


def _floors(best: DataFrame, keys: Sequence[str], k: int, name: str) -> DataFrame:
    """The ``k``-th best score per key; NULL where fewer entities are known, so that nothing is below it."""
    return best.groupBy(*keys).agg(F.when(F.count(F.lit(1)) >= k, F.min(rounded(F.col("score")))).alias(name))


def _reaches(floor: str, bonus: float) -> Column:
    """Whether a signature can come to a floor, if it earns the bonus in every document whose name matched."""
    best = (F.col("base") + F.size("matched") * F.lit(bonus)) / F.col("n_sources")
    return F.col(floor).isNull() | (rounded(best) >= F.col(floor))


def profile_edges(left: DataFrame, documents: DataFrame, sources: Sequence[str], k: int = CANDIDATES) -> DataFrame:
    """Best ``k`` entities of every record profile: ``(lk, dkey, date, entity_id, score)``."""
    entities = entity_profiles(documents, sources)
    # The lists are read several times below; stored, they are sorted out once.
    both = store_step(_smallest(entities, ["sig", "sig_devs", "sig_dates"], k), "entities")
    by_devs = store_step(_smallest(both, ["sig", "sig_devs"], k).select("sig", "entity_id", "docs"), "by_devs")
    by_date = store_step(_smallest(both, ["sig", "sig_dates"], k).select("sig", "entity_id", "docs"), "by_date")
    by_name = store_step(_smallest(by_devs, ["sig"], k, place="place"), "by_name")

    # Which name signatures a left name of several terms meets, in which sources, and the summed name score.
    statistics = _name_statistics(documents)
    firsts = by_name.where(F.col("place") == 1)
    members = firsts.select("sig", F.col("entity_id").alias("first"), F.size("docs").alias("n_sources"), F.explode("docs").alias("d"))
    met = (
        name_candidates(left.where(F.contains("lkey", F.lit(" "))), documents, statistics)
        .join(members.select("sig", "first", "n_sources", "d.source", "d.rkey"), ["source", "rkey"])
        .groupBy("lkey", "sig", "first", "n_sources")
        .agg(F.sum("score").alias("base"), F.array_sort(F.collect_list("source")).alias("matched"))
    )
    met = store_step(met, "names").withColumn("lk", _digest(F.col("lkey")))
    weights = store_step(one_term_weights(left, statistics), "weights").withColumn("lk", _digest(F.col("lkey")))
    size = weights.agg(F.sum(F.length("lkey") + 64 * F.size("weights") + 64)).first()[0] or 0
    to_all = F.broadcast if size <= _BROADCAST_BYTES else lambda df: df
    score = lambda bonus: (F.col("base") + bonus) / F.col("n_sources")

    # Each signature has an entity, so the best five lie in the five signatures that are best by score and smallest id.
    place = F.row_number().over(Window.partitionBy("lk").orderBy(rounded(score(F.lit(0.0))).desc(), F.col("first").asc()))
    nearest = met.withColumn("_place", place).where(F.col("_place") <= k)
    names_only = nearest.join(by_name.select("sig", "entity_id"), "sig").select("lk", "entity_id", score(F.lit(0.0)).alias("score"))
    one_term = _met_by_one_term(by_name, to_all(weights)).select("lk", "entity_id", score(F.lit(0.0)).alias("score"))
    plain = store_step(_best(names_only.unionByName(one_term), ["lk"], k), "plain")

    floors = store_step(_floors(plain, ["lk"], k, "floor"), "floors")
    near = store_step(met.select("lk", "sig", "n_sources", "base", "matched").join(floors, "lk").where(_reaches("floor", DEV_BONUS + DATE_BONUS)), "near")
    open_weights = to_all(store_step(weights.join(floors, "lk"), "open_weights"))
    # Every name with a candidate has one in ``plain``; other records have no edge.
    profiles = store_step(record_profiles(left).join(floors, "lk"), "profiles")
    with_devs = profiles.where(F.size("devs") > 0).withColumn("dev", F.element_at("devs", 1)).withColumnRenamed("devs", "l_devs")
    with_date = profiles.where(F.col("date").isNotNull()).withColumnRenamed("date", "l_date")
    lean = F.transform("docs", lambda d: F.struct(d["source"], d["devs"], d["date"])).alias("docs")
    dev_keys = F.explode(F.array_distinct(F.flatten(F.transform("docs", lambda d: d["devs"])))).alias("dev")
    slots = F.filter(F.array_distinct(F.transform("docs", lambda d: _date_slot(d["date"]))), lambda s: s.isNotNull())

    def candidates(wanted: DataFrame, entities: DataFrame, keys: Sequence[str], by_key, bonus: float) -> DataFrame:
        """Records and the entities of a list that they meet under ``keys``; ``by_key`` gives every row of the list its keys.

        The record's side of a bonus is attached first, so that lists are met by signature (or term) and developer or time slot at once. What
        cannot come to the record's floor with ``bonus`` is left out before.
        """
        slotted = lambda df: df.withColumn("slot", _near_slots(F.col("l_date"))) if "slot" in keys else df
        own = [c for c in wanted.columns if c not in keys and c not in ("lk", "floor")]
        columns = ["lk", *own, "base", "n_sources", "matched", "entity_id", "docs"]
        asked = near.where(_reaches("floor", bonus)).drop("floor").join(wanted, "lk").where(_reaches("floor", bonus)).drop("floor")
        several = slotted(asked).join(by_key(entities.select("sig", "entity_id", lean)), ["sig", *keys])
        found = _met_by_one_term(entities, open_weights).where(_reaches("floor", bonus)).select("lk", "entity_id", "n_sources", "base", "matched", lean)
        one = by_key(found).join(slotted(wanted), ["lk", *keys])
        return several.select(*columns).unionByName(one.where(_reaches("floor", bonus)).select(*columns))

    devs_only = (
        candidates(with_devs.select("lk", "floor", "dkey", "dev", "l_devs").distinct(), by_devs, ["dev"], lambda df: df.select("*", dev_keys), DEV_BONUS)
        .withColumn("n_devs", _count(_devs_met))
        .where(F.col("n_devs") > 0)
        .select("lk", "dkey", "entity_id", score(F.col("n_devs") * DEV_BONUS).alias("score"))
    )
    devs_only = store_step(_best(devs_only, ["lk", "dkey"], k), "devs_only")

    date_only = (
        candidates(with_date.select("lk", "floor", "l_date").distinct(), by_date, ["slot"], lambda df: df.select("*", F.explode(slots).alias("slot")), DATE_BONUS)
        .withColumn("n_dates", _count(_date_met))
        .where(F.col("n_dates") > 0)
        .select("lk", F.col("l_date").alias("date"), "entity_id", score(F.col("n_dates") * DATE_BONUS).alias("score"))
        .distinct()
    )
    date_only = _best(date_only, ["lk", "date"], k)

    higher = F.greatest("floor", "dev_floor").alias("floor")
    full = (
        with_devs.where(F.col("date").isNotNull())
        .withColumnRenamed("date", "l_date")
        .join(_floors(devs_only, ["lk", "dkey"], k, "dev_floor"), ["lk", "dkey"], "left")
        .select("lk", "dkey", "dev", "l_devs", "l_date", higher)
    )
    dev_and_date = (
        candidates(full, both, ["dev", "slot"], lambda df: df.select("*", dev_keys).withColumn("slot", F.explode(slots)), DEV_BONUS + DATE_BONUS)
        .withColumn("n_devs", _count(_devs_met))
        .withColumn("n_dates", _count(_date_met))
        .where((F.col("n_devs") > 0) & (F.col("n_dates") > 0))
        .select(
            "lk",
            "dkey",
            F.col("l_date").alias("date"),
            "entity_id",
            score(F.col("n_devs") * DEV_BONUS + F.col("n_dates") * DATE_BONUS).alias("score"),
        )
        .distinct()
    )
    dev_and_date = _best(dev_and_date, ["lk", "dkey", "date"], k)

    key = ["lk", "dkey", "date"]
    profile = profiles.select(*key)
    union = (
        profile.join(plain, "lk")
        .unionByName(profile.join(devs_only, ["lk", "dkey"]))
        .unionByName(profile.join(date_only, ["lk", "date"]))
        .unionByName(dev_and_date.select(*key, "entity_id", "score"))
    )
    return _best(union.groupBy(*key, "entity_id").agg(F.max("score").alias("score")), key, k)


def candidate_edges(
    records: DataFrame,
    earlier: DataFrame,
    sources: Sequence[str],
    k: int = CANDIDATES,
    stop_words: Sequence[str] = STOP_WORDS,
    for_matching: bool = False,
) -> DataFrame:
    """Edges ``(left_id, entity_id, score)``, at most ``k`` per record.

    ``for_matching`` drops edges that cannot be chosen: records of one profile have the same edges, so with ``k`` entities
    in reach only the ``k`` smallest ids among them can ever be matched.
    """
    # Both sides are read many times below; these narrow tables spare the scans and the analysis of full records.
    left = store_step(left_records(records, stop_words).drop("terms"), "records")
    documents = store_step(right_documents(earlier, stop_words).drop("bag"), "documents")
    edges = profile_edges(left, documents, sources, k)
    key = ["lk", "dkey", "date"]
    members = left.withColumn("lk", _digest(F.col("lkey"))).select("left_id", *key)
    if for_matching:
        place = F.row_number().over(Window.partitionBy(*key).orderBy("left_id"))
        members = members.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")
    m, e = members.alias("m"), edges.alias("e")
    same = (F.col("m.lk") == F.col("e.lk")) & (F.col("m.dkey") == F.col("e.dkey")) & F.col("m.date").eqNullSafe(F.col("e.date"))
    return m.join(e, same).select("m.left_id", "e.entity_id", "e.score")


def assign_one_to_one(edges: DataFrame, plain_rounds: int = PLAIN_ROUNDS) -> DataFrame:
    """Matches ``(left_id, entity_id, score)``: every entity keeps its best record, displaced records fall back.

    With edges ordered by score, record id and entity id there is one stable outcome. It is reached by rounds: edges that
    are best for both their ends are final, and their ends leave. Best edges are plain minima, merged on the map side, so an
    entity wanted by very many records is no hot spot. A round is one job: it stores its matches and the edges left over in
    the shared folder, the next round reads those, and the edges read before are deleted. Every round settles at least one edge.

    Records that displace each other one after the other would take a round each. From the ``plain_rounds``-th round on, such chains are
    settled at once, see :func:`_settled_chains`.
    """
    spark = edges.sparkSession
    base = step_path(spark, "assign")
    schema = "left_id string, entity_id string, score double, neg double"
    ranked = edges.select("left_id", "entity_id", "score", (-rounded(F.col("score"))).alias("neg"))
    ranked.withColumn("kind", F.lit("edge")).write.partitionBy("kind").parquet(f"{base}/0")
    rounds = 0
    while exists(spark, f"{base}/{rounds}/kind=edge"):
        open_edges = spark.read.schema(schema).parquet(f"{base}/{rounds}/kind=edge")
        if rounds < plain_rounds:
            chosen = _best_for_both(open_edges)
        else:
            log.info("round %d: chains among %d open edges", rounds + 1, open_edges.count())
            chosen = _settled_chains(open_edges)
        rest = open_edges.join(chosen.select("left_id"), "left_id", "left_anti").join(
            chosen.select("entity_id"), "entity_id", "left_anti"
        )
        both = chosen.withColumn("kind", F.lit("match")).unionByName(rest.withColumn("kind", F.lit("edge")))
        rounds += 1
        both.write.partitionBy("kind").parquet(f"{base}/{rounds}")
        delete(spark, f"{base}/{rounds - 1}/kind=edge")
    log.info("%d rounds", rounds)
    paths = [f"{base}/{n}/kind=match" for n in range(1, rounds + 1)]
    if not paths:
        return edges.select("left_id", "entity_id", "score").limit(0)
    return spark.read.schema(schema).parquet(*paths).select("left_id", "entity_id", "score")


_EDGE = ["left_id", "entity_id", "score", "neg"]


def _best_for_both(open_edges: DataFrame) -> DataFrame:
    """Edges that are the best of both their ends."""
    best_of_record = open_edges.groupBy("left_id").agg(F.min(F.struct("neg", "entity_id", "score")).alias("b"))
    best_of_entity = open_edges.groupBy("entity_id").agg(F.min(F.struct("neg", "left_id")).alias("b"))
    return best_of_record.select("left_id", "b.entity_id", "b.score", "b.neg").join(
        best_of_entity.select("entity_id", F.col("b.left_id").alias("left_id")), ["left_id", "entity_id"]
    )


def _two_best(open_edges: DataFrame, end: str, other: str) -> DataFrame:
    """Per end its best edge and the one after it, as plain minima: ``<end>, first, second`` (other end; NULL where there is none)."""
    order = F.struct("neg", other)
    best = open_edges.groupBy(end).agg(F.min(order).alias("b"))
    rest = open_edges.join(best, end).where(order != F.col("b")).groupBy(end).agg(F.min(order).alias("c"))
    return best.join(rest, end, "left").select(end, F.col(f"b.{other}").alias("first"), F.col(f"c.{other}").alias("second"))


def _settled_chains(open_edges: DataFrame) -> DataFrame:
    """Edges that are the best of both ends, and all that follow from them along chains.

    An edge with exactly one better edge at its ends is chosen if and only if that one is not. Such edges point to the better one; pointers
    are doubled, with the parity of the steps, until none gets any further, so a chain takes as many jobs as its length has
    binary digits. Those that end at an edge best for both ends are settled by their parity; those that end at an edge with several better
    ones wait for the next round.
    """
    records, entities = _two_best(open_edges, "left_id", "entity_id"), _two_best(open_edges, "entity_id", "left_id")
    placed = (
        open_edges.join(records.select("left_id", F.col("first").alias("r1"), F.col("second").alias("r2")), "left_id")
        .join(entities.select("entity_id", F.col("first").alias("e1"), F.col("second").alias("e2")), "entity_id")
        .withColumn("r", F.when(F.col("entity_id") == F.col("r1"), 0).when(F.col("entity_id") == F.col("r2"), 1).otherwise(2))
        .withColumn("e", F.when(F.col("left_id") == F.col("e1"), 0).when(F.col("left_id") == F.col("e2"), 1).otherwise(2))
    )
    placed = store_step(placed.select(*_EDGE, "r1", "e1", "r", "e"), "placed")
    best = placed.where((F.col("r") == 0) & (F.col("e") == 0)).select(*_EDGE)
    after_own = F.col("r") == 1
    ways = placed.where(F.col("r") + F.col("e") == 1).select(
        *_EDGE,
        F.when(after_own, F.col("left_id")).otherwise(F.col("e1")).alias("to_left"),
        F.when(after_own, F.col("r1")).otherwise(F.col("entity_id")).alias("to_entity"),
        F.lit(True).alias("odd"),
    )
    ways = store_step(ways, "ways")
    on = [("to_left", "left_id", "next_left"), ("to_entity", "entity_id", "next_entity")]
    while True:
        steps = ways.select(*[F.col(c).alias(to) for to, c, _ in on], *[F.col(to).alias(further) for to, _, further in on], F.col("odd").alias("more"))
        further = F.col("next_left").isNotNull()
        joined = ways.join(steps, [to for to, _, _ in on], "left").select(
            *_EDGE,
            F.coalesce("next_left", "to_left").alias("to_left"),
            F.coalesce("next_entity", "to_entity").alias("to_entity"),
            F.when(further, F.col("odd") != F.col("more")).otherwise(F.col("odd")).alias("odd"),
            further.alias("moved"),
        )
        stored = store_step(joined, "ways")
        ways = stored.drop("moved")
        if stored.where("moved").isEmpty():
            break
    ends = best.select(F.col("left_id").alias("to_left"), F.col("entity_id").alias("to_entity"))
    follow = ways.where(~F.col("odd")).join(ends, ["to_left", "to_entity"], "left_semi")
    return best.unionByName(follow.select(*_EDGE))


def new_entity_id(source: Column, record_id: Column) -> Column:
    return F.sha2(F.concat_ws(":", source, record_id), 256)


def with_entity_ids(records: DataFrame, matches: DataFrame | None) -> DataFrame:
    """Matched records reuse the entity, all others get one of their own; ``reused`` tells which."""
    fresh = new_entity_id(F.col("source"), F.col("id"))
    rows = records.drop("entity_id")
    if matches is None:
        return rows.withColumn("entity_id", fresh).withColumn("reused", F.lit(False))
    found = matches.select(F.col("left_id").alias("id"), F.col("entity_id").alias("_found"))
    return (
        rows.join(found, "id", "left")
        .withColumn("entity_id", F.coalesce("_found", fresh))
        .withColumn("reused", F.col("_found").isNotNull())
        .drop("_found")
    )


def resolution_stats(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("source").agg(
        F.count_if("reused").alias("reused"), F.count_if(~F.col("reused")).alias("generated")
    )


def resolve_sources(spark: SparkSession, catalogues: Sequence[tuple[str, DataFrame]], k: int = CANDIDATES) -> DataFrame:
    """Resolve sources one after the other, each against all before it.

    The loop runs over sources only. Every step is a distributed job that ends in a table in the shared folder, so a later
    step never recomputes an earlier one.
    """
    base = step_path(spark, "resolve")
    done: list[str] = []
    for i, (name, catalogue) in enumerate(catalogues):
        with step_tables(spark):
            matches = None
            if done:
                earlier = spark.read.parquet(*[f"{base}/{j}" for j in range(i)])
                matches = assign_one_to_one(candidate_edges(catalogue, earlier, done, k, for_matching=True))
            with_entity_ids(catalogue, matches).write.parquet(f"{base}/{i}")
        done.append(name)
    return spark.read.parquet(*[f"{base}/{j}" for j in range(len(done))])


def explain_edges(edges: DataFrame, records: DataFrame, earlier: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """What an edge earns in each document of its entity: ``(left_id, entity_id, source, name_met, date_bonus, dev_bonus)``."""
    left = left_records(records, stop_words).select(
        "left_id", "lkey", F.col("devs").alias("l_devs"), F.col("date").alias("l_date")
    )
    documents = right_documents(earlier, stop_words).select(
        "entity_id", "source", "rkey", F.struct("devs", "date").alias("d")
    )
    rows = edges.select("left_id", "entity_id").join(left, "left_id").join(documents, "entity_id")
    name_met = F.size(F.array_except(_bag(F.col("lkey")), _bag(F.col("rkey")))) == 0
    dev_met = name_met & (F.size("l_devs") > 0) & _devs_met(F.col("d"))
    return rows.select(
        "left_id",
        "entity_id",
        "source",
        name_met.alias("name_met"),
        F.when(name_met & _date_met(F.col("d")), DATE_BONUS).otherwise(0.0).alias("date_bonus"),
        F.when(dev_met, DEV_BONUS).otherwise(0.0).alias("dev_bonus"),
    )
