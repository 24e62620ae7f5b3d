"""Near-duplicate lines: an exact set-similarity join on rarity-ordered word prefixes (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.tables import let, stored
from rowtide.session import broadcast_if_small, shuffle_width

#: Similarity of matching lines in hundredths.
LEAST = 80
#: Powers of two that bound the buckets of the frequency table, and the bytes of text a bucket stands for.
FEWEST, MOST, BUCKET_BYTES = 12, 24, 512
#: Lines of fewer distinct words match equal sets only (3 of 4 is less than 0.8).
SMALLEST = 4
#: Frequency classes are twice the binary logarithm of a count plus 1: of two occurrences, and of 256.
TWICE, FREQUENT = 3, 16
#: Lines of like length in a list of a frequent word above which they try the earliest one first.
LONG_LIST = 64
#: Distinct words for which a match must share one more word of the prefixes; parity of 64 bits says nothing of sets twice as large.
STEP = 64


def split_lines(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, ``more``, ``line_no`` from 0 and lower-cased ``line`` of every text; white space other than line ends becomes a space."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *more, _spaced("text").alias("text"))  # a generator would compute it again and again
    return docs.select("doc_id", *more, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _spaced(text: str) -> Column:
    text = F.lower(F.coalesce(text, F.lit("")))
    odd = F.contains(text, F.lit("\t")) | F.contains(text, F.lit("\r")) | F.contains(text, F.lit("\v")) | F.contains(text, F.lit("\f"))
    return F.when(odd, F.translate(text, "\t\r\v\f", "    ")).otherwise(text)


def _bucket(h: Column, bits: int) -> Column:
    return F.shiftrightunsigned(h, 64 - bits).cast("int")


def bucket_bits(docs: DataFrame) -> int:
    """Binary logarithm of the buckets: more for more text, so that rare words stay told apart from frequent ones."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(MOST, max(FEWEST, (size // BUCKET_BYTES).bit_length()))


def frequency_classes(docs: DataFrame, bits: int) -> DataFrame:
    """Counts of all words by hash bucket on a logarithmic scale: one row with an array of a byte a bucket, 16 MB at most; stored."""
    texts = docs.select(F.replace(_spaced("text"), F.lit("\n"), F.lit(" ")).alias("text"))
    words = texts.select(F.explode(F.split("text", " ")).alias("w")).where("w <> ''")
    words = words.select(_bucket(F.xxhash64("w"), bits).alias("b"), F.lit(1).alias("n"))
    every = docs.sparkSession.range(1 << bits).select(F.col("id").cast("int").alias("b"), F.lit(0).alias("n"))
    counts = words.unionByName(every).groupBy("b").agg(F.sum("n").alias("n"))
    level = F.least(F.lit(62), F.floor(F.log2(F.col("n") + 1) * 2)).cast("tinyint")

    def in_order(key: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct(key, "x"))), lambda x: x["x"])

    parts = counts.select("b", level.alias("x")).groupBy(F.shiftright("b", 10).alias("part")).agg(in_order("b").alias("x"))
    return stored(parts.agg(F.flatten(in_order("part")).alias("levels")), "levels")


def _tokens(rows: DataFrame, levels: DataFrame, bits: int, *keep: str) -> DataFrame:
    """``keep`` and ``t``, the distinct words of ``line`` as numbers that sort by rarity: six bits of frequency class, then 57 of hash."""

    def number(h: Column) -> Column:
        level = F.shiftleft(F.get("levels", _bucket(h, bits)).cast("long"), 57)
        return F.coalesce(level.bitwiseOR(F.shiftrightunsigned(h, 7)), F.lit(0))  # never null, so that it sorts fast

    words = F.array_distinct(F.transform(F.array_remove(F.split("line", " "), ""), lambda w: F.xxhash64(w)))
    rows = rows.withColumn("levels", levels.scalar())
    return rows.select(*keep, F.sort_array(F.transform(words, number)).alias("t"))


def _ceil_share(n: Column, share: int, of: int) -> Column:
    return F.call_function("div", n * share + (of - 1), F.lit(of).cast("long")).cast("int")


def _set_rows(lines: DataFrame, levels: DataFrame, bits: int) -> DataFrame:
    """Per line: ``n`` distinct words, the set's digest (h1, h2), its parity bitmap and its prefix as 31-bit list keys.

    A key has the frequency class on top. A word that occurs once in the table is in no other line and in no prefix.
    """
    rows = _tokens(lines, levels, bits, "doc_id", "line_no", "doc_key")
    n = F.size("t")
    one = F.lit(1).cast("long")
    parity = F.aggregate("t", F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(F.call_function("shiftleft", one, x.bitwiseAND(F.lit(63)).cast("int"))))
    shared = F.filter(F.slice("t", 1, _prefix_length(n)), lambda x: x >= F.lit(TWICE << 57))
    return rows.select(
        "doc_id",
        "line_no",
        "doc_key",
        n.alias("n"),
        F.xxhash64("t").alias("h1"),
        F.xxhash64(F.lit(1), "t").alias("h2"),
        F.when(n >= SMALLEST, F.transform(shared, lambda x: F.shiftright(x, 32).cast("int"))).alias("prefix"),
        F.when((n >= SMALLEST) & (n < 2 * STEP), parity).alias("bits"),
    )


def _least_shared(n: Column) -> Column:
    """How many words the prefixes of two matching sets share, if the smaller has ``n`` words."""
    return (1 + F.call_function("div", n, F.lit(STEP))).cast("int")


def _prefix_length(n: Column) -> Column:
    return n - _ceil_share(n, LEAST, 100) + _least_shared(n)


def _postings(classes: DataFrame, *more: str) -> DataFrame:
    """A row per prefix word of every class; ``most`` is the largest set with which a match may share the word at this place of the prefix."""
    n, before = F.col("n"), _prefix_length(F.col("n")) - F.size("prefix")
    posted = classes.select("uid", "n", "bits", *more, before.alias("_before"), F.posexplode("prefix").alias("_at", "token"))
    left = n - F.col("_at") - F.col("_before") + _least_shared(n) - 1
    most = F.call_function("div", left.cast("long") * (100 + LEAST), F.lit(LEAST).cast("long")) - n
    return posted.select("token", "uid", "n", most.alias("most"), "bits", *more)


def _may_match(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    """Length, positional and parity filters for two postings (n, most, bits) of one list."""
    both = a[0] + b[0]
    alike = F.bit_count(a[2].bitwiseXOR(b[2])) <= both - _ceil_share(both, LEAST, 100 + LEAST) * 2
    return (a[0] <= b[1]) & (b[0] <= a[1]) & F.coalesce(alike, F.lit(True))


def _hub_pairs(classes: DataFrame) -> DataFrame:
    """Pairs (x, y) of a class and the earliest one of like length in a long list of a frequent word."""
    like = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).cast("int")
    posted = _postings(classes, "first").where(F.col("token") >= FREQUENT << 25).withColumn("like", like)
    long = posted.groupBy("token", "like").agg(F.count("*").alias("many")).where(F.col("many") > LONG_LIST).select("token", "like")
    posted = stored(posted.join(broadcast_if_small(stored(long, "long_lists")), ["token", "like"], "left_semi"), "in_long_lists")
    hubs = posted.groupBy("token", "like").agg(F.min(F.struct("first", "uid", "n", "most", "bits")).alias("hub"))
    met = posted.alias("p").join(hubs, ["token", "like"]).where(F.col("p.uid") != F.col("hub.uid"))
    p, hub = ([F.col(f"{side}.{c}") for c in ("n", "most", "bits")] for side in ("p", "hub"))
    return met.where(_may_match(tuple(p), tuple(hub))).select(F.col("p.uid").alias("x"), F.col("hub.uid").alias("y")).distinct()


def _list_pairs(classes: DataFrame, done: DataFrame) -> DataFrame:
    """Pairs (x, y) that share enough words of their prefixes and of which at least one is not ``done``.

    The lists are shuffled once, in narrow rows, and joined with themselves. ``span`` holds n, most and whether the class is done.
    """
    done = broadcast_if_small(done.select(F.col("late").alias("_late")))
    flagged = classes.join(done, classes["uid"] == done["_late"], "left").withColumn("done", F.col("_late").isNotNull().cast("long"))
    span = F.shiftleft(F.col("n").cast("long"), 33).bitwiseOR(F.shiftleft(F.col("most"), 1)).bitwiseOR(F.col("done"))
    posted = _postings(flagged, "done").select("token", "uid", span.alias("span"), "bits")

    def parts(side: str) -> tuple[Column, Column, Column]:
        whole = F.col(f"{side}.span")
        return F.shiftright(whole, 33).cast("int"), F.shiftright(whole, 1).bitwiseAND(F.lit(0xFFFFFFFF)), F.col(f"{side}.bits")

    a, b = parts("a"), parts("b")
    open_ = F.col("a.span").bitwiseAND(F.col("b.span")).bitwiseAND(F.lit(1)) == 0
    on = (F.col("a.token") == F.col("b.token")) & (F.col("a.uid") < F.col("b.uid")) & _may_match(a, b) & open_
    met = posted.alias("a").join(posted.alias("b"), on)
    need = _least_shared(F.least(a[0], b[0])).alias("need")
    shared = met.select(F.col("a.uid").alias("x"), F.col("b.uid").alias("y"), need).groupBy("x", "y", "need").count()
    return shared.where(F.col("count") >= F.col("need")).select("x", "y")


def _matched(docs: DataFrame, classes: DataFrame, levels: DataFrame, bits: int, pairs: DataFrame) -> DataFrame:
    """``late``, the later class of those ``pairs`` (x, y) whose sets verify; only documents of candidate lines are read again."""
    wanted = broadcast_if_small(stored(pairs.select(F.explode(F.array("x", "y")).alias("uid")).distinct(), "wanted_ids"), 1 << 20)
    firsts = stored(classes.join(wanted, "uid", "left_semi").select("uid", "h1", "first"), "wanted")
    places = firsts.groupBy(F.col("first.doc_id").alias("_id"), F.col("first.doc_key").alias("_key"))
    places = broadcast_if_small(stored(places.agg(F.collect_list(F.struct("uid", "h1", "first")).alias("_at")), "places"))
    found = docs.join(places, docs["doc_id"].eqNullSafe(places["_id"]) & (docs["doc_key"] == places["_key"]))
    found = found.select("_at", _spaced("text").alias("text"))
    line = let(F.split("text", "\n"), lambda every: F.transform("_at", lambda at: F.struct(at, F.get(every, at["first"]["line_no"]))))
    sets = _tokens(found.select(F.inline(line).alias("at", "line")).select("at.*", "line"), levels, bits, "uid", "h1", "first")
    sets = sets.where(F.xxhash64("t") == F.col("h1")).select("uid", "first", "t")
    sets = stored(sets, "sets")
    if sets.count() > firsts.count():  # rows repeating id and text give a line twice
        sets = stored(sets.dropDuplicates(["uid"]), "sets_once")
    both = pairs.join(sets.select(F.col("uid").alias("x"), F.col("first").alias("_fx"), F.col("t").alias("_a")), "x")
    both = both.join(sets.select(F.col("uid").alias("y"), F.col("first").alias("_fy"), F.col("t").alias("_b")), "y")
    common = F.size(F.array_intersect("_a", "_b"))
    good = both.where(common * 100 >= (F.size("_a") + F.size("_b") - common) * LEAST)
    later = F.struct("_fx", "x") > F.struct("_fy", "y")  # nulls first
    return stored(good.select(F.when(later, F.col("x")).otherwise(F.col("y")).alias("late")).distinct(), "matched")


def line_decisions(docs: DataFrame) -> DataFrame:
    """doc_id, ``line_no``, ``removed`` and ``near`` of every line of ``docs`` (doc_id, text).

    A line is removed when an earlier one (by doc_id, nulls first, then line number) has the same distinct words, lower-cased and
    parted by white space, or (``near``) a Jaccard similarity of 0.8 or more with it. Lines without words stay.
    A null text is one empty line; rows repeating id and text count as one document. Words are told apart by 57-bit hashes
    and sets by 128 bits. Other columns are ignored; an empty table gives no rows.

    Copies are counted as one class before the join. In the lists of frequent words every class first tries the earliest one of like
    length; then lists are joined with themselves but for pairs of classes that are both matched already, so that a large group of near
    copies costs a pair per member. Lists of rare words are short.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("doc_key"))
    lines = split_lines(docs, "doc_key")
    bits = bucket_bits(docs)
    levels = frequency_classes(docs, bits)
    rows = stored(_set_rows(lines, levels, bits), "line_sets")
    worded = rows.where("n > 0")
    first = F.min(F.struct("doc_id", "line_no", "doc_key")).alias("first")
    kept = [F.first(c).alias(c) for c in ("n", "prefix", "bits")]
    classes = worded.groupBy("h1", "h2").agg(first, F.count("*").alias("many"), *kept)
    classes = stored(classes.withColumn("uid", F.monotonically_increasing_id()), "line_classes")

    done = _matched(docs, classes, levels, bits, stored(_hub_pairs(classes), "hub_pairs"))
    near = done.unionByName(_matched(docs, classes, levels, bits, stored(_list_pairs(classes, done), "list_pairs")))
    near = broadcast_if_small(stored(near.distinct(), "near"))

    verdicts = classes.join(near, classes["uid"] == near["late"], "left").where((F.col("many") > 1) | F.col("late").isNotNull())
    verdicts = verdicts.select("h1", "h2", F.struct("first.doc_id", "first.line_no").alias("first"), F.col("late").isNotNull().alias("near"))
    judged = worded.select("doc_id", "line_no", "h1", "h2").join(broadcast_if_small(stored(verdicts, "verdicts")), ["h1", "h2"], "left")
    gone = F.col("near") | ~F.struct("doc_id", "line_no").eqNullSafe(F.col("first"))
    judged = judged.select("doc_id", "line_no", (F.col("first").isNotNull() & gone).alias("removed"), F.coalesce("near", F.lit(False)).alias("near"))
    blank = rows.where("n = 0").select("doc_id", "line_no", F.lit(False).alias("removed"), F.lit(False).alias("near"))
    return judged.unionByName(blank)


def removed_lines(docs: DataFrame) -> DataFrame:
    """Per doc_id: ``n_lines``, ``n_removed``, ``n_near`` and the numbers of the removed lines, comma-joined in ``removed``."""
    rows = line_decisions(docs)
    one = F.when(F.col("removed"), F.col("line_no"))
    found = rows.groupBy("doc_id").agg(
        (F.max("line_no") + 1).cast("long").alias("n_lines"), F.collect_set(one).alias("_gone"), F.count(F.when(F.col("near"), 1)).alias("n_near")
    )
    return found.select("doc_id", "n_lines", F.size("_gone").cast("long").alias("n_removed"), "n_near", F.array_join(F.sort_array("_gone"), ",").alias("removed"))


def without_lines(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """``docs`` with the removed lines of ``decisions`` (of ``line_decisions``) cut from ``text``; all rows and columns stay."""
    gone = decisions.where("removed").groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("_gone")).withColumnRenamed("doc_id", "_id")
    rows = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]), "left")
    lines = F.split("text", "\n")
    at = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))  # hashed, so linear in the lines
    left = F.array_join(let(lines, lambda all_lines: F.transform(at, lambda i: F.get(all_lines, i))), "\n")
    text = F.when(F.col("_gone").isNotNull() & F.col("text").isNotNull(), left).otherwise(F.col("text"))
    return rows.withColumn("text", text).select(*docs.columns)
