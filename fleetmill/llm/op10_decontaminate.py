r"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

Texts and benchmark items become word sequences in which numbers, names (capitalised words, also at
the start of a sentence, where a name can't be told from another word: both then stand alike in a
copy) and units after numbers are typed placeholders that keep their values aside. Windows of
five template words, of which three or more are plain, are hash-joined with the items' windows. An
item whose distinct windows are covered to THRESHOLD or more by a document is a candidate. Then
slots are checked: at the alignment that most windows share, each of the item's slot values should
stand for one value of the document throughout. For each value the document's most frequent one
agrees and others contradict; a candidate goes if contradictions outnumber agreements. So a
re-parameterised copy (all 3s turned to 7s, or 3 and 4 both to 5) is caught, also one in which a
few values were altered, and a text of the same form whose values are at random is not.

Names are told by their case, so texts in capitals have other templates. Windows of five plain
words, case folded and whatever stands between them, are therefore joined too, and documents that
cover an item's plain windows to THRESHOLD or more hold it, whatever its slots. A pair found both
ways has the figures of its templates. Items of one to four words are held by documents that
consist of these words (one window each).

Most documents are put aside before that by an exact filter: one that covers an item has to have one
of the item's few keys (pairs of words, see keys_of), of its templates or its plain windows. Keys
are joined by hash like windows: broadcast while few, else by a shuffle.

Null and empty texts and items match nothing, nor do items without a word. Rows with a null doc_id
or item_id are not reported. Repeated rows of one id count as one document or item (texts that share
an id add up). Very long texts are read whole. Of alignments that tie, the one nearest the text's
start is taken. Empty tables on either side give no rows. Extra columns, whatever their names, are
not read. Common windows need no cap: each window row finds only the items that hold it, and counts
are pre-aggregated by document and item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetmill.llm.common import Tables, join_small, materialize, read, rows_of

WINDOW, PLAIN, THRESHOLD = 5, 3, 0.8
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons pound pounds lb lbs oz ml l liter liters litre litres "
    "second seconds minute minutes hour hours day days week weeks month months year years percent dollar dollars cent cents euro euros degree degrees mph kmh watt watts volt volts"
).split()
#: Marks of placeholders; they are no letters, so no word begins with one.
NAME, NUMBER, UNIT = "§", "#", "¤"


def marked_words(text: Column) -> Column:
    """Words, lower-cased, names with NAME before them; a decimal number is one word."""
    t = F.regexp_replace(text, r"[§¤]", " ")
    t = F.regexp_replace(t, r"([0-9])[.,:/]([0-9])", "$1_$2")
    t = F.regexp_replace(t, r"(^|[^\p{L}\p{M}\p{N}_])(\p{Lu})", "$1" + NAME + "$2")
    words = F.split(F.lower(t), r"[^\p{L}\p{M}\p{N}_§]+")
    return F.filter(words, lambda w: w != "")


def folded(text: Column) -> Column:
    """Text without case; ß is SS in capitals, and a sigma has two small forms."""
    return F.replace(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def plain_words(text: Column) -> Column:
    return F.filter(F.split(folded(text), r"[^\p{L}\p{M}\p{N}_]+"), lambda w: w != "")


def plain_windows(df: DataFrame, key: str, text: str, with_words: bool = False) -> DataFrame:
    """``(key, window)`` and, if asked for, the window's words: one row for each five words."""
    words = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, plain_words(F.col(text)).alias("t")).where(F.size("t") >= WINDOW)
    hashed = words.select(key, *(["t"] if with_words else []), F.transform("t", lambda w: F.xxhash64(w)).alias("h"))
    places = F.sequence(F.lit(0), F.size("h") - WINDOW)
    out = hashed.select(key, *(["t"] if with_words else []), F.posexplode(F.transform(places, lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)]))).alias("at", "window"))
    return out.select(key, "window", F.slice("t", F.col("at") + 1, WINDOW).alias("words")) if with_words else out.select(key, "window")


def windows(df: DataFrame, key: str, text: str, with_words: bool = False) -> DataFrame:
    """``(key, at, window)`` and, if asked for, the window's words: one row for each window of each row with enough words, but those
    where fewer than PLAIN words are plain. Each step is a column of its own, so that it is
    computed once for a row."""
    words = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, marked_words(F.col(text)).alias("words"))
    typed = words.select(key, F.transform("words", lambda w: F.when(F.substring(w, 1, 1).between("0", "9"), NUMBER).when(F.substring(w, 1, 1) == NAME, NAME).otherwise(w)).alias("t"))
    typed = typed.where(F.size("t") >= WINDOW)
    with_units = F.transform("t", lambda w, i: F.when(w.isin(UNITS) & (F.get("t", i - 1) == NUMBER), UNIT).otherwise(w))
    typed = typed.select(key, F.when(F.array_contains("t", NUMBER), with_units).otherwise(F.col("t")).alias("t"))
    # plain words have even hashes, placeholders odd ones
    hashed = typed.select(key, *(["t"] if with_words else []), F.transform("t", lambda w: F.xxhash64(w).bitwiseAND(-2).bitwiseOR(w.isin(NUMBER, NAME, UNIT).cast("long"))).alias("h"))

    def one(i: Column) -> Column:
        own = [F.get("h", i + k) for k in range(WINDOW)]
        typed_words = own[0].bitwiseAND(1)
        for x in own[1:]:
            typed_words = typed_words + x.bitwiseAND(1)
        return F.when(typed_words <= WINDOW - PLAIN, F.xxhash64(*own))

    places = F.sequence(F.lit(0), F.size("h") - WINDOW)
    out = hashed.select(key, *(["t"] if with_words else []), F.posexplode(F.transform(places, one)).alias("at", "window")).where("window is not null")
    return out.withColumn("words", F.slice("t", F.col("at") + 1, WINDOW)).drop("t") if with_words else out


def keys_of(of_items: DataFrame, totals: DataFrame, threshold: float, letters: str) -> DataFrame:
    """``(key)``: hashes of word pairs of which every document that covers an item has at least one,
    with a null if no such pair exists. Of an item's n distinct windows a document may miss n -
    ceil(threshold n); of one window more than that it has one, and so that window's words, side by
    side. Of each window the longest pair of words that fit ``letters`` is taken, and those windows
    whose pairs are longest, as few other documents have them."""
    sides = F.zip_with(F.slice("words", 1, WINDOW - 1), F.slice("words", 2, WINDOW - 1), lambda a, b: F.struct((F.length(a) + F.length(b)).alias("n"), a.alias("a"), b.alias("b")))
    longest = F.array_max(F.filter(sides, lambda p: p["a"].rlike(letters) & p["b"].rlike(letters)))
    one = of_items.groupBy("item_id", "window").agg(F.max(longest).alias("key")).join(totals, "item_id")
    rank = F.row_number().over(W.partitionBy("item_id").orderBy(F.desc_nulls_last("key.n"), "key.a", "key.b", "window"))
    needed = one.withColumn("rank", rank).where(F.col("rank") <= F.col("n_windows") - F.ceil(threshold * F.col("n_windows")) + 1)
    pair = F.xxhash64(folded(F.col("key.a")), folded(F.col("key.b")))
    return needed.select(F.when(F.col("key").isNotNull(), pair).alias("key")).distinct()


def with_keys(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose text has one of the keys. Words that are all letters are the same in a text whether
    or not names and numbers are marked."""
    n = rows_of(keys)
    if not n:
        return docs.limit(0)
    if not keys.where("key is null").isEmpty():
        return docs
    words = docs.where("doc_id is not null and text is not null").select("doc_id", F.split(folded(F.col("text")), r"[^\p{L}\p{M}\p{N}_]+").alias("w"))
    # one row a word, but only those that match go on; the last word has none beside it, which matches nothing
    pairs = words.select("doc_id", F.explode(F.zip_with("w", F.slice("w", F.lit(2), F.size("w")), lambda a, b: F.xxhash64(a, b))).alias("key"))
    found, _ = materialize(join_small(pairs, keys, "key", "left_semi", n).select("doc_id").distinct())
    return join_small(docs, found, "doc_id", "left_semi")


def agreeing(values: Column) -> Column:
    """Of pairs (a, b): for each a how often its most frequent b stands, added up."""
    counted = F.transform(F.array_distinct(values), lambda p: F.struct(p["a"].alias("a"), F.size(F.filter(values, lambda q: q == p)).alias("n")))
    first = F.array_distinct(F.transform(values, lambda p: p["a"]))
    most = F.transform(first, lambda a: F.array_max(F.transform(F.filter(counted, lambda c: c["a"] == a), lambda c: c["n"])))
    return F.aggregate(most, F.lit(0), lambda x, y: x + y)


def short_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that consist of the words of an item of one to four."""
    words = lambda df, key: df.where(F.col(key).isNotNull() & F.col("text").isNotNull()).select(key, plain_words(F.col("text")).alias("t")).where(F.size("t").between(1, WINDOW - 1)).select(key, F.concat_ws(" ", "t").alias("t"))
    own, _ = materialize(words(items, "item_id").distinct())
    held = words(docs, "doc_id") if rows_of(own) else words(docs.limit(0), "doc_id")  # mostly there are no such items
    return join_small(held, own, "t", "inner").select("doc_id", "item_id", *[F.lit(n).cast("long").alias(c) for c, n in (("n_windows", 1), ("n_found", 1), ("n_slots", 0), ("n_agree", 0))])


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs(doc_id, text)``, ``items(item_id, text)`` -> ``(doc_id, item_id, n_windows, n_found,
    n_slots, n_agree)``: the documents that hold an item, one row for each pair."""
    tables = Tables()
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    of_items = tables.put(windows(items, "item_id", "text", with_words=True).withColumnRenamed("at", "item_at"))
    totals = of_items.groupBy("item_id").agg(F.count_distinct("window").alias("n_windows"))
    plain_of_items = tables.put(plain_windows(items, "item_id", "text", with_words=True))
    plain_totals = plain_of_items.groupBy("item_id").agg(F.count_distinct("window").alias("n_windows"))
    keys = keys_of(of_items, totals, threshold, r"^\p{L}+$").union(keys_of(plain_of_items, plain_totals, threshold, ""))
    # written, so that nothing is done to the texts of the others
    searched = tables.put(with_keys(docs, tables.put(keys.distinct())))
    hits = join_small(windows(searched, "doc_id", "text"), of_items.drop("words"), "window", "inner")
    per_shift = hits.groupBy("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).agg(F.count(F.lit(1)).alias("n"), F.collect_set("window").alias("found"))
    # sets of one item's windows: bounded by the item's length
    found = per_shift.groupBy("doc_id", "item_id").agg(F.size(F.array_distinct(F.flatten(F.collect_set("found")))).alias("n_found"), F.max(F.struct("n", -F.col("shift"))).alias("best"))
    candidates = found.join(totals, "item_id").where(F.col("n_found") >= threshold * F.col("n_windows"))
    # written, as it is counted before it is joined
    candidates = tables.put(candidates.select("doc_id", "item_id", "n_windows", "n_found", (-F.col("best")["col2"]).alias("shift")))

    item_words = items.where("item_id is not null and text is not null").select("item_id", marked_words(F.col("text")).alias("item_words"))
    aligned = join_small(docs, candidates, "doc_id", "inner").select("doc_id", "item_id", "n_windows", "n_found", "shift", marked_words(F.col("text")).alias("words"))
    aligned = aligned.join(item_words, "item_id")
    kind = lambda w: F.when(F.substring(w, 1, 1).between("0", "9"), NUMBER).when(F.substring(w, 1, 1) == NAME, NAME)
    same = lambda i: F.coalesce(F.get("item_words", i) == F.get("words", i + F.col("shift")), F.lit(False))
    # beyond an inserted or left-out word the alignment is off: only slots beside an equal word count
    pairs = F.transform("item_words", lambda w, i: F.struct(w.alias("a"), F.get("words", i + F.col("shift")).alias("b"), (same(i - 1) | same(i + 1)).alias("beside")))
    slots = F.filter(pairs, lambda p: p["beside"] & p["b"].isNotNull() & kind(p["a"]).isNotNull() & (kind(p["a"]) == kind(p["b"])))
    slots = F.transform(slots, lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b")))
    checked = aligned.withColumn("slots", slots).withColumns({"n_slots": F.size("slots").cast("long"), "n_agree": agreeing(F.col("slots")).cast("long")}).where("2 * n_agree >= n_slots")
    templates = checked.groupBy("doc_id", "item_id").agg(F.max("n_windows").alias("n_windows"), F.max("n_found").cast("long").alias("n_found"), F.max("n_slots").alias("n_slots"), F.max("n_agree").alias("n_agree"))

    plain_hits = join_small(plain_windows(searched, "doc_id", "text"), plain_of_items.select("item_id", "window").distinct(), "window", "inner")
    plain_found = plain_hits.groupBy("doc_id", "item_id").agg(F.count_distinct("window").alias("n_found")).join(plain_totals, "item_id").where(F.col("n_found") >= threshold * F.col("n_windows"))
    plain = plain_found.select("doc_id", "item_id", "n_windows", "n_found", *[F.lit(0).cast("long").alias(c) for c in ("n_slots", "n_agree")]).unionByName(short_items(docs, items))
    rows = templates.withColumn("plain", F.lit(0)).unionByName(plain.withColumn("plain", F.lit(1)))
    figures = ("n_windows", "n_found", "n_slots", "n_agree")
    first = F.min(F.struct("plain", *figures)).alias("first")
    return tables.finish(rows.groupBy("doc_id", "item_id").agg(first).select("doc_id", "item_id", *[F.col(f"first.{c}").alias(c) for c in figures]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_WORDS = (
    r"list_filter(regexp_split_to_array(lower(regexp_replace(regexp_replace(regexp_replace(text, '[§¤]', ' ', 'g'), '([0-9])[.,:/]([0-9])', '\1_\2', 'g'), "
    r"'(^|[^\p{L}\p{M}\p{N}_])(\p{Lu})', '\1§\2', 'g')), '[^\p{L}\p{M}\p{N}_§]+'), lambda x: x <> '')"
)
_KIND = "CASE WHEN {0}[1] BETWEEN '0' AND '9' THEN '#' WHEN {0}[1] = '§' THEN '§' END"
ORACLE_SQL = rf"""
WITH src AS (SELECT 'd' AS k, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
m AS (SELECT k, id, {_WORDS} AS w FROM src WHERE id IS NOT NULL AND text IS NOT NULL),
f AS (SELECT k, id, w, list_transform(w, lambda x: coalesce({_KIND.format("x")}, x)) AS f FROM m),
t AS (SELECT k, id, w, list_transform(f, lambda x, i: CASE WHEN i > 1 AND f[i - 1] = '#' AND x IN ({", ".join(f"'{u}'" for u in UNITS)}) THEN '¤' ELSE x END) AS t FROM f WHERE len(f) >= 5),
g AS (SELECT k, id, t, unnest(range(1, len(t) - 3)) AS p FROM t),
win AS (SELECT k, id, p, t[p:p + 4] AS x FROM g WHERE len(list_filter(t[p:p + 4], lambda y: y NOT IN ('#', '§', '¤'))) >= 3),
total AS (SELECT id AS item_id, count(DISTINCT x) AS n_windows FROM win WHERE k = 'i' GROUP BY 1),
hit AS (SELECT d.id AS doc_id, i.id AS item_id, d.p - i.p AS shift, d.x FROM win d JOIN win i ON d.x = i.x WHERE d.k = 'd' AND i.k = 'i'),
cov AS (SELECT doc_id, item_id, count(DISTINCT x) AS n_found FROM hit GROUP BY 1, 2),
best AS (SELECT doc_id, item_id, shift FROM (SELECT doc_id, item_id, shift, count(*) AS n FROM hit GROUP BY 1, 2, 3)
  QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n DESC, shift) = 1),
cand AS (SELECT * FROM cov JOIN best USING (doc_id, item_id) JOIN total USING (item_id) WHERE n_found >= 0.8 * n_windows),
aligned AS (SELECT c.*, d.w AS dw, i.w AS iw, unnest(range(1, len(i.w) + 1)) AS q FROM cand c JOIN t d ON d.k = 'd' AND d.id = c.doc_id JOIN t i ON i.k = 'i' AND i.id = c.item_id),
pair AS (SELECT *, iw[q] AS a, CASE WHEN q + shift >= 1 THEN dw[q + shift] END AS b,
  (q > 1 AND q - 1 + shift >= 1 AND coalesce(iw[q - 1] = dw[q - 1 + shift], false)) OR (q + 1 + shift >= 1 AND coalesce(iw[q + 1] = dw[q + 1 + shift], false)) AS beside FROM aligned),
slot AS (SELECT *, beside AND b IS NOT NULL AND coalesce({_KIND.format("a")} = {_KIND.format("b")}, false) AS is_slot FROM pair),
agree AS (SELECT doc_id, item_id, sum(m) AS n_agree FROM (SELECT doc_id, item_id, max(n) AS m FROM (SELECT doc_id, item_id, a, b, count(*) AS n FROM slot WHERE is_slot GROUP BY ALL) GROUP BY doc_id, item_id, a) GROUP BY ALL),
templates AS (SELECT doc_id, item_id, max(n_windows) AS n_windows, max(n_found) AS n_found, count(*) FILTER (is_slot) AS n_slots, coalesce(max(n_agree), 0) AS n_agree FROM slot LEFT JOIN agree USING (doc_id, item_id) GROUP BY ALL
  HAVING 2 * coalesce(max(n_agree), 0) >= count(*) FILTER (is_slot)),
pw AS (SELECT k, id, list_filter(regexp_split_to_array(replace(replace(lower(text), 'ß', 'ss'), 'ς', 'σ'), '[^\p{{L}}\p{{M}}\p{{N}}_]+'), lambda x: x <> '') AS w FROM src WHERE id IS NOT NULL AND text IS NOT NULL),
pg AS (SELECT DISTINCT k, id, w[p:p + 4] AS x FROM (SELECT k, id, w, unnest(range(1, len(w) - 3)) AS p FROM pw WHERE len(w) >= 5)),
plain AS (SELECT d.id AS doc_id, i.id AS item_id, max(n) AS n_windows, count(*) AS n_found FROM pg d JOIN pg i ON d.x = i.x JOIN (SELECT id, count(*) AS n FROM pg WHERE k = 'i' GROUP BY 1) t ON t.id = i.id
  WHERE d.k = 'd' AND i.k = 'i' GROUP BY 1, 2 HAVING count(*) >= 0.8 * max(n)),
short AS (SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM pw d JOIN pw i ON d.w = i.w WHERE d.k = 'd' AND i.k = 'i' AND len(i.w) BETWEEN 1 AND 4),
held AS (SELECT *, 0 AS p FROM templates UNION ALL SELECT doc_id, item_id, n_windows, n_found, 0, 0, 1 FROM plain UNION ALL SELECT doc_id, item_id, 1, 1, 0, 0, 1 FROM short)
SELECT doc_id, item_id, n_windows::BIGINT AS n_windows, n_found::BIGINT AS n_found, n_slots::BIGINT AS n_slots, n_agree::BIGINT AS n_agree FROM held QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY p) = 1
"""
