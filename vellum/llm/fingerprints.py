"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A text's terms are its words (runs of non-blank characters) weighted by their counts. Each of SAMPLES samples is drawn
over all terms of the text: hashes of a term give it r ~ Gamma(2, 1), c ~ Gamma(2, 1) and b ~ U(0, 1); with weight w its
quantum is t = floor(ln w / r + b) and its rank c exp(-r (t - b + 1)), and the sample is (term, t) of least rank. Two texts
agree in a sample with a chance equal to the generalised Jaccard similarity of their weights; likeness is the share of
samples that agree.

The variables are drawn so that a word that comes once, as most do, costs one hash. With S, E, F ~ Exp(1) independent,
c = S + E, e = ln(c / S), r = e + F and b = 1 - e / r have the distributions above, and the rank is S exp(-r t). So S
comes from the first hash, and t = 0 where w = 1: the least rank there is the greatest hash. Words that come more
often are ranked a row for each sample that they can win, and each sample takes the greater of both.

Documents are dealt by ranges of doc_id, and every later step (the next document, counts, bins, likeness) stays
within a range: the text is shuffled once. The first document of a range stands in the range before it as a guest,
so that the last one there finds its successor.

Defined results: null text is empty; an empty fingerprint is likest to another empty one (1.0) and to no other (0.0);
rows that share a doc_id follow each other in order of text; null doc_ids come last, in order of text; a single row
is its own successor; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import parts_for, text_bytes

SAMPLES = 128
#: Samples to a row where words that come once are drawn: as many columns as one compiled method takes well.
BLOCK = 16
BLANK = r"[\x20\x09-\x0D]+"
#: Bytes of text in a range, and the most limits between ranges that are computed.
RANGE_BYTES, LIMITS = 2 << 20, 1000


def _uniform(h: Column, shift: int) -> Column:
    """A number in (0, 1) from 32 bits of h."""
    return (F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(0xFFFFFFFF)).cast("double") + F.lit(0.5)) / F.lit(float(1 << 32))


def draw(term: Column, sample: Column) -> Column:
    """The hash that orders the terms of weight 1 of a sample: greatest first. Its low 24 bits name (term, t = 0)."""
    return F.xxhash64(term, sample)


def _level(h: Column) -> Column:
    """The number in (0, 1) that a draw or a value stands for."""
    return (F.shiftright(h, 24).cast("double") + F.lit(float(1 << 39) + 0.5)) / F.lit(float(1 << 40))


def may_win(h: Column, weight: Column, best: Column) -> Column:
    """Whether a term of some weight can come before `best`, the greatest draw of weight 1: its rank S exp(-r t) is at
    least (1 - q) exp(-F) / weight, and the rank of best at most (1 - q) / q of best."""
    least = (F.lit(1.0) - _level(h)) * _uniform(F.xxhash64(h, F.lit(1)), 32)
    return best.isNull() | (least * _level(best) <= weight * (F.lit(1.0) - _level(best)))


def ranked(rows: DataFrame) -> DataFrame:
    """rows with h (a draw) and weight: value, which orders terms of any weight among the draws, with (term, t) in its low
    24 bits."""
    top = float(1 << 40)
    rows = rows.withColumn("__s", -F.log(_level(F.col("h")))).withColumn("__h2", F.xxhash64("h", F.lit(1)))
    rows = rows.withColumn("__e", F.log(F.lit(1.0) - F.log(_uniform(F.col("__h2"), 0)) / F.col("__s")))
    rows = rows.withColumn("__r", F.col("__e") - F.log(_uniform(F.col("__h2"), 32)))
    rows = rows.withColumn("__t", F.floor((F.log(F.col("weight").cast("double")) - F.col("__e")) / F.col("__r")) + F.lit(1))
    # exp(-rank) is uniform, as q is for weight 1
    level = F.least(F.floor(F.exp(-F.col("__s") * F.exp(-F.col("__r") * F.col("__t"))) * F.lit(top)), F.lit((1 << 40) - 1)) - F.lit(1 << 39)
    name = (F.col("h") + F.col("__t") * F.lit(0x9E3779B1)).bitwiseAND(F.lit(0xFFFFFF))
    value = F.when(F.col("__t") <= 0, F.col("h")).otherwise(F.shiftleft(level.cast("long"), 24).bitwiseOR(name))
    return rows.withColumn("value", value).drop("__s", "__h2", "__e", "__r", "__t")


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing samples of two arrays of (sample << 24 | name)."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b))).cast("double")


def _ranges(docs: DataFrame) -> DataFrame:
    """docs with route (higher: greater doc_id, -1: null) and guests (guest = true), each the first row of the next range."""
    parts = min(LIMITS, parts_for(text_bytes(docs), RANGE_BYTES))
    cuts = []
    if parts > 1:
        row = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10000).alias("q")).first()
        cuts = sorted(set(row["q"] or []))
    limits = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else None
    place = F.size(F.filter(limits, lambda c: c <= F.col("doc_id"))) if cuts else F.lit(0)
    routed = docs.withColumn("route", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(place).cast("int"))
    # the first row of each range; at most LIMITS + 1 of them, by id alone
    first = {r["route"]: r["top"] for r in routed.groupBy("route").agg(F.max("doc_id").alias("top")).collect()}
    order = sorted(first, reverse=True)
    guests = None
    for i, route in enumerate(order):
        after = order[(i + 1) % len(order)]
        if after >= 0:
            guests = (guests or []) + [(first[after], route)]
    routed = routed.withColumn("guest", F.lit(False))
    out = routed
    if guests:
        pairs = F.array(*[F.struct(F.lit(i).cast("long").alias("__id"), F.lit(r).cast("int").alias("__to")) for i, r in guests])
        to = F.broadcast(docs.sparkSession.range(1).select(F.inline(pairs)))  # one row per range
        found = docs.join(to, F.col("doc_id") == F.col("__id")).groupBy(F.col("__to").alias("route"), "doc_id").agg(F.min("text").alias("text"))
        out = out.unionByName(found.select("doc_id", "text", "route", F.lit(True).alias("guest")))
    if -1 in first:
        before = order[order.index(-1) - 1]
        least = docs.where("doc_id is null").agg(F.min("text").alias("text")).select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(before).cast("int").alias("route"), F.lit(True).alias("guest"))
        out = out.unionByName(least)
    return out


def report(documents: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("route").orderBy(F.col("guest"), F.col("doc_id").desc(), "text")
    rows = _ranges(docs).withColumn("rn", F.row_number().over(order)).withColumn("after", F.coalesce(F.lead("text").over(order), F.lit("")))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.length("text") - half), F.col("after").substr(F.lit(1), half))
    # one element that no word can be (it starts with a blank) carries the facts of the row
    facts = F.concat_ws("|", F.lit(" "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.length("text").cast("string"), F.sha2("edited", 256), F.col("guest").cast("string"))
    rows = rows.withColumn("edited", edited)
    split = lambda c: F.split(F.col(c), BLANK)
    both = F.array(F.struct(F.lit(0).alias("v"), F.array_append(split("text"), facts).alias("w")), F.struct(F.lit(1).alias("v"), split("edited").alias("w")))
    terms = rows.select("route", "rn", F.explode(both).alias("b")).select("route", "rn", "b.v", F.explode("b.w").alias("word")).where("word <> ''")
    fact = F.col("word").startswith(" ")
    terms = terms.select("route", "rn", "v", F.when(~fact, F.xxhash64("word")).alias("term"), F.when(fact, F.col("word")).alias("facts"))
    counted = terms.groupBy("route", "rn", "v", "term", "facts").agg(F.count(F.lit(1)).alias("n"))
    # words that come once: rows of BLOCK samples, a column for each; the others go along as they are
    single, often = (F.col("n") == 1) & F.col("term").isNotNull(), F.col("often")
    blocks = F.explode(F.when(single, F.array(*map(F.lit, range(samples // BLOCK)))).otherwise(F.array(F.lit(-1)))).alias("j")
    dealt = counted.select("route", "rn", "v", "facts", "term", F.when(~single, F.col("term")).alias("often"), F.when(~single, F.col("n")).alias("weight"), blocks)
    least = [F.max(F.when(F.col("j") >= 0, draw(F.col("term"), F.col("j") * BLOCK + k))).alias(f"s{k}") for k in range(BLOCK)]
    dealt = dealt.groupBy("route", "rn", "v", "j", "facts", "often", "weight").agg(*least)
    packed = dealt.groupBy("route", "rn", "v").agg(
        F.max("facts").alias("facts"),
        F.collect_list(F.when(often.isNotNull(), F.struct(often.alias("term"), "weight"))).alias("often"),
        F.array_sort(F.collect_list(F.when(F.col("j") >= 0, F.struct("j", F.array(*[f"s{k}" for k in range(BLOCK)]).alias("s"))))).alias("s"),
    )
    blank = F.array(*[F.lit(None).cast("long")] * samples)
    packed = packed.withColumn("s", F.when(F.size("s") == 0, blank).otherwise(F.flatten("s.s")))
    none = F.struct(F.lit(None).cast("long").alias("term"), F.lit(None).cast("long").alias("weight"))
    rows = packed.select("route", "rn", "v", "facts", "s", F.explode(F.concat(F.array(none), "often")).alias("x"))
    rows = rows.select("route", "rn", "v", F.when(F.col("x.term").isNull(), F.col("facts")).alias("facts"), "x.term", "x.weight", F.posexplode("s").alias("k", "s"))
    rows = rows.select("route", "rn", "v", F.when(F.col("k") == 0, F.col("facts")).alias("facts"), "k", "s", "weight", F.when(F.col("term").isNotNull(), draw(F.col("term"), F.col("k"))).alias("h"))
    rows = rows.where(F.col("h").isNull() | may_win(F.col("h"), F.col("weight"), F.col("s")))
    values = ranked(rows).groupBy("route", "rn", "v", "k", "facts").agg(F.max(F.when(F.col("h").isNull(), F.col("s")).otherwise(F.col("value"))).alias("value"))
    best = values.groupBy("route", "rn", "v", "k").agg(F.max("facts").alias("facts"), F.max("value").alias("value"))
    entry = F.when(F.col("value").isNotNull(), F.shiftleft(F.col("k").cast("long"), 24).bitwiseOR(F.col("value").bitwiseAND(F.lit(0xFFFFFF))))
    signed = best.groupBy("route", "rn").agg(
        F.max("facts").alias("facts"),
        F.array_sort(F.collect_list(F.when(F.col("v") == 0, entry))).alias("own"),
        F.array_sort(F.collect_list(F.when(F.col("v") == 1, entry))).alias("other"),
    )
    signed = signed.withColumn("next", F.lead("own").over(Window.partitionBy("route").orderBy("rn"))).withColumn("f", F.split("facts", r"\|"))
    text = lambda c: F.array_join(F.transform(F.col(c), lambda e: F.lpad(F.lower(F.hex(e)), 8, "0")), "")
    part = lambda i: F.element_at("f", i)
    return signed.where(part(5) == "false").select(
        F.nullif(part(2), F.lit("")).cast("long").alias("doc_id"),
        part(3).cast("long").alias("n_chars"),
        part(4).alias("edited_sha256"),
        text("own").alias("fingerprint"),
        text("other").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.coalesce("next", F.array().cast("array<bigint>"))).alias("near_next"),
    )
