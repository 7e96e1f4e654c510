"""Benchmark decontamination on a positional inverted index, with DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bit_filter, marked, maybe_in, saved

#: What separates words once A-Z are small, as a class of a regular expression: fixed by the contract.
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of a frame that is sent whole to every executor, at most.
SMALL_BYTES = 16 << 20


def word_list(text: str = "text") -> Column:
    """The words of a column in order; none for null."""
    found = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"[^{SEPARATORS}]+"), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def _small(df: DataFrame, *strings: str) -> DataFrame:
    """``df`` marked for a broadcast if its bytes, counted first, allow it."""
    sizes = [F.octet_length(c) for c in strings]
    rows, text = df.agg(F.count("*"), sum((F.sum(s) for s in sizes), F.lit(0))).first()
    return F.broadcast(df) if 64 * rows + (text or 0) <= SMALL_BYTES else df


def build_index(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """The postings of ``docs``, written as a table: (row, term, pos), one for
    each occurrence of a word, or of a word in ``terms`` (distinct, column
    term).  A posting with a null term ends every row's list; its pos is the
    number of all words, and it alone carries the doc_id.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", word_list().alias("words"))
    end = F.array(F.lit(None).cast("string"))
    postings = rows.select("row", "doc_id", F.posexplode(F.concat("words", end)).alias("pos", "term"))
    if terms is not None:
        listed = _small(terms, "term")
        if listed is terms:  # too many to send: a bounded filter, which lets some others through
            postings = marked(postings, bit_filter(terms, "term"), "term").where("_maybe OR term IS NULL")
        else:
            postings = postings.join(F.broadcast(terms.withColumn("listed", F.lit(True))), "term", "left").where(
                "listed OR term IS NULL")
    return saved(postings.select("row", "term", F.col("pos").cast("int").alias("pos"),
                                 F.when(F.col("term").isNull(), F.col("doc_id")).alias("doc_id")))


def item_phrases(items: DataFrame, size: int = 10) -> tuple[DataFrame, DataFrame]:
    """The distinct runs of ``size`` consecutive words of ``items`` as written
    tables: (phrase, terms) with a number each, and (phrase, item_id)."""
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1))),
                       lambda i: F.array_join(F.slice(F.col("words"), i, size), " "))
    words = items.select("item_id", word_list().alias("words")).where("size(words) > 0")
    held = saved(words.select("item_id", F.explode(runs).alias("text")).distinct())
    texts = held.select("text").distinct()
    phrases = saved(texts.select(F.monotonically_increasing_id().alias("phrase"), "text"))
    owners = held.join(phrases, "text").select("phrase", F.col("item_id").cast("string").alias("item_id"))
    return phrases.select("phrase", F.split("text", " ").alias("terms")), saved(owners)


def plan_phrases(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase, n, steps): the terms of every phrase that can occur, with
    their offsets, from the fewest postings to the most."""
    counts = saved(index.where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("postings")))
    places = phrases.select("phrase", F.size("terms").alias("n"), F.posexplode("terms").alias("off", "term"))
    known = places.join(_small(counts, "term"), "term")
    steps = F.array_sort(F.collect_list(F.struct("postings", "off", "term")))
    return saved(known.groupBy("phrase", "n").agg(steps.alias("steps")).where("size(steps) = n"))


def phrase_matches(index: DataFrame, plans: DataFrame) -> DataFrame:
    """(row, phrase, start, n): every exact occurrence, as a written table.

    The postings of each phrase's rarest term, less its offset, are the first
    list of starts.  It is intersected with the adjusted list of the second
    rarest term, and what is left with those of all other terms at once; only
    postings of rows that still have a start are read for that.
    """
    words = index.where("term IS NOT NULL").select("row", "term", "pos")
    step = F.col("steps")
    seeds = _small(plans.select("phrase", "n", step[0]["term"].alias("term"), step[0]["off"].alias("off"),
                                F.get(step, F.lit(1))["term"].alias("term2"), F.get(step, F.lit(1))["off"].alias("off2")),
                   "term", "term2")
    starts = words.join(seeds, "term").where("pos >= off").select(
        "row", "phrase", "n", (F.col("pos") - F.col("off")).alias("start"), "term2", "off2")
    single = starts.where("n = 1").select("row", "phrase", "start", "n")
    second = words.join(_small(plans.where("n > 1").select(step[1]["term"].alias("term")).distinct(), "term"), "term", "left_semi")
    pairs = starts.where("n > 1").select("row", "phrase", "n", "start", F.col("term2").alias("term"),
                                         (F.col("start") + F.col("off2")).alias("pos"))
    both = saved(pairs.join(second, ["row", "pos", "term"], "left_semi").select("row", "phrase", "start", "n"))
    open_ = both.where("n > 2")
    rest = plans.where("n > 2").select("phrase", F.slice("steps", 3, 1 << 30).alias("rest"))
    wanted = open_.join(_small(rest.select("phrase", F.explode("rest").alias("at")).select("phrase", "at.term", "at.off"), "term"),
                        "phrase").select("row", "phrase", "start", "n", "term", (F.col("start") + F.col("off")).alias("pos"))
    near = maybe_in(words, bit_filter(open_.select("row").distinct(), "row"), "row")
    full = (wanted.join(near, ["row", "pos", "term"], "left_semi").groupBy("row", "phrase", "start", "n")
            .agg(F.count("*").alias("found")).where("found = n - 2").drop("found"))
    return saved(single.unionByName(both.where("n = 2")).unionByName(full))


def near_matches(index: DataFrame, plans: DataFrame, span: int) -> DataFrame:
    """(row, phrase, start, end): places where all distinct terms of a phrase
    lie within ``span`` words, in any order, around a posting of its rarest
    term; of the places of one such posting the leftmost, end exclusive.

    The second rarest term's postings within ``span`` of the rarest one's are
    found in blocks of ``span`` positions and thin the candidates out before
    the other terms' postings are read.
    """
    words = index.where("term IS NOT NULL").select("row", "term", "pos", F.floor(F.col("pos") / span).alias("block"))
    distinct = F.array_distinct(F.transform("steps", lambda s: s["term"]))
    plans = saved(plans.select("phrase", distinct.alias("own")).select("phrase", "own", F.size("own").alias("m")))
    seeds = words.drop("block").join(_small(plans.select("phrase", "m", F.col("own")[0].alias("term"),
                                                         F.get("own", F.lit(1)).alias("second")), "term", "second"), "term")
    alone = seeds.where("m = 1").select("row", "phrase", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"))
    around = F.explode(F.sequence(F.floor((F.col("pos") - span + 1) / span), F.floor((F.col("pos") + span - 1) / span)))
    close = F.abs(F.col("at") - F.col("pos")) < span
    other = words.withColumnRenamed("pos", "at")
    second = other.join(_small(plans.where("m > 1").select(F.col("own")[1].alias("term")).distinct(), "term"), "term", "left_semi")
    first = seeds.where("m > 1").select("row", "phrase", "m", "pos", F.col("second").alias("term"), around.alias("block"))
    pairs = saved(first.join(second, ["row", "block", "term"]).where(close).select("row", "phrase", "m", "pos").distinct())
    wanted = pairs.join(_small(plans.select("phrase", F.explode("own").alias("term")), "term"), "phrase").select(
        "row", "phrase", "m", "pos", "term", around.alias("block"))
    read = maybe_in(other, bit_filter(pairs.select("row").distinct(), "row"), "row")
    found = wanted.join(read, ["row", "block", "term"]).where(close).groupBy("row", "phrase", "m", "pos").agg(
        F.sort_array(F.collect_set(F.struct("at", "term"))).alias("seen")).where("size(seen) >= m")

    def last(left):  # the end of the shortest stretch from ``left`` that holds all terms, null if none
        inside = F.filter("seen", lambda x: (x["at"] >= left) & (x["at"] < left + span))
        ends = F.transform("own", lambda t: F.array_min(F.transform(F.filter(inside, lambda x: x["term"] == t), lambda x: x["at"])))
        return F.when(F.exists(ends, lambda e: e.isNull()), None).otherwise(F.array_max(ends) + 1)

    spots = F.transform("seen", lambda x: F.struct(x["at"].alias("start"), last(x["at"]).alias("end")))
    hits = found.join(_small(plans.select("phrase", "own")), "phrase").withColumn("spots", F.filter(
        spots, lambda s: s["end"].isNotNull() & (s["start"] <= F.col("pos")) & (s["end"] > F.col("pos"))))
    best = hits.where("size(spots) > 0").select("row", "phrase", F.col("spots")[0].alias("spot"))
    return alone.unionByName(best.select("row", "phrase", "spot.start", "spot.end")).distinct()


def contamination(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated.

    An item's windows are its runs of ``size`` words, or all its words if it
    has fewer.  A word inside an occurrence of a window is hit; n_items counts
    the item ids with such a window, items_sha256 is of their sorted list.

    Null, empty and wordless texts have no words: nothing hits them, and as
    items they have no windows.  Rows under one doc_id are rows of their own;
    items under one id count as one; the words of an item without id are hit,
    but it is not listed.  An empty table of documents gives an empty result,
    of items one without hits; other columns are not read.
    """
    phrases, owners = item_phrases(items, size)
    terms = saved(phrases.select(F.explode("terms").alias("term")).distinct())
    index = build_index(docs, terms)
    matches = phrase_matches(index, plan_phrases(index, phrases))

    earlier = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    gain = end - F.greatest("start", F.coalesce(F.max(end).over(earlier), F.col("start")))
    hit = (matches.groupBy("row", "start").agg(F.max("n").alias("n")).select("row", F.greatest(gain, F.lit(0)).alias("gain"))
           .groupBy("row").agg(F.sum("gain").cast("long").alias("n_hit")))
    listed = matches.select("row", "phrase").distinct().join(_small(owners.where("item_id IS NOT NULL"), "item_id"), "phrase")
    named = listed.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    rows = index.where("term IS NULL").select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    out = rows.join(hit, "row", "left").join(named, "row", "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
                      (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


#: The same in DuckDB's SQL: windows of every size that items have, by equality.
TWIN = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
      '[^{SEPARATORS}]+'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^{SEPARATORS}]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, list_slice(w, s, s + least(10, len(w)) - 1) AS phrase
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 10 + 1, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
z AS (SELECT DISTINCT len(phrase) AS n FROM p),
o AS (SELECT r, s, n, list_slice(w, s, s + n - 1) AS phrase FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, z)),
m AS (SELECT r, s, n, item_id FROM o JOIN p USING (phrase)),
h AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + n)) AS q FROM m) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r)"""
