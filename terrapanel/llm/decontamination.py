"""Benchmark decontamination by templates: DataFrame functions only.

A text becomes a template: capitalised words within a sentence turn into ``<name>``, numbers in digits
or words into ``<num>``, and a unit after a number into ``<unit>``; what stays is lower-cased without
punctuation.  White space is never touched, so word i of a template comes from word i of its text.
Windows of ``WINDOW`` template words of all documents meet those of the benchmark in a hash join; a
passage whose numbers or names were exchanged has the same windows.  So do the windows of the literal words
in lower case, which find copies in other case or with names where the template doesn't see them.

A matched stretch counts as a copy of an item when it holds enough of the item's windows, words put in or
left out between them or not, and the slots are consistent: each number or name of the item stands for one
value throughout the matched windows; what goes before, between and after them is not judged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapanel.sources.shared import table

WINDOW = 8
#: An item is in a document when so many hundredths of its windows are, in one stretch: on diagonals that begin
#: within half the item's length.
LEAST_SHARE = 50
#: More windows of the benchmark than this are joined by a shuffle instead of a broadcast (16 bytes each and overhead).
BROADCAST_WINDOWS = 200_000
#: Windows of documents are looked up only where they begin with a pair of words that a window of the benchmark begins
#: with, unless there are more such pairs (8 bytes each) than this.
MOST_PAIRS = 20_000
#: More stretches of documents than this are joined to the texts by a shuffle (a few hundred bytes each).
BROADCAST_STRETCHES = 50_000

#: Words for numbers, and units that may follow a number.
NUMBER_WORDS = "two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen|twenty|thirty|forty|fifty|sixty|seventy|eighty|ninety|hundred|thousand|million|billion"
#: The letters that they begin with.
FIRST_LETTERS = "".join(sorted({x[0] for x in NUMBER_WORDS.split("|")}))
UNITS = "percent|km|m|cm|mm|kg|g|mg|lb|lbs|oz|l|ml|mph|miles?|met(?:er|re)s?|kilomet(?:er|re)s?|feet|foot|inch(?:es)?|yards?|pounds?|grams?|kilograms?|lit(?:er|re)s?|gallons?|seconds?|minutes?|hours?|days?|weeks?|months?|years?|dollars?|cents?|euros?|degrees?"

#: Each slot that a matched window holds and its word in the document, by the diagonal with most windows among those with such a one.
PLACES = f"filter(transform(slots, s -> struct(s, s + get(filter(parts, p -> exists(p.ats, a -> s - a >= 0 AND s - a < {WINDOW})), 0).begin AS at)), x -> x.at IS NOT NULL)"

SPACE = r"[\\x20\\x09-\\x0D]+"


def template(text: str) -> str:
    """SQL for the template of a text column.  Patterns begin with the characters they are about, so that most places
    fail at the first of them."""
    mark = "[\\\\p{P}\\\\p{S}&&[^<>]]"
    t = f"regexp_replace({text}, '\\\\p{{Lu}}(?<=[\\\\p{{L}}\\\\p{{N}},;] \\\\p{{Lu}})\\\\p{{Ll}}+', '<name>')"
    t = f"lower({t})"
    t = f"regexp_replace({t}, '\\\\p{{N}}+(?:[.,:/]\\\\p{{N}}+)*|(?=[{FIRST_LETTERS}])(?<![\\\\p{{L}}<])(?:{NUMBER_WORDS})(?![\\\\p{{L}}>])', '<num>')"
    t = f"regexp_replace({t}, '<num>([ -]?)(?:{UNITS})(?![\\\\p{{L}}>])', '<num>$1<unit>')"
    return f"regexp_replace({t}, '{mark}(?<=[\\\\p{{L}}>]{mark}){mark}*|{mark}+(?=[\\\\p{{L}}<])', '')"


def literal(text: str) -> str:
    """SQL for a text column in lower case, its words without punctuation at the edges."""
    inside, mark = "[\\\\p{L}\\\\p{N}\\\\p{M}]", "[\\\\p{P}\\\\p{S}]"
    edge = "[^\\\\x20\\\\x09-\\\\x0D]"
    return f"regexp_replace(lower({text}), '{mark}(?<={inside}{mark}){mark}*+(?!{edge})|{mark}(?<!{edge}{mark}){mark}*(?={inside})', '')"


def _words(text: str) -> str:
    return f"array_remove(split({text}, '{SPACE}'), '')"


def _windows(size: int, words: str = "words", begins: list[int] | None = None) -> str:
    """SQL for the windows of an array of words; with ``begins`` those alone that begin with such a pair of words."""
    parts = ", ".join(f"{words}[i + {k}]" for k in range(size))
    places = f"sequence(0, size({words}) - {size})"
    if begins is not None and size > 1:
        places = f"filter({places}, i -> xxhash64({words}[i], {words}[i + 1]) IN ({', '.join(f'{x}L' for x in begins)}))"
    return f"if(size({words}) < {size}, array(), transform({places}, i -> struct(xxhash64({size}, {parts}) AS h, i AS at)))"


def find_copies(docs: DataFrame, benchmark: DataFrame, least_share: int = LEAST_SHARE) -> DataFrame:
    """``doc_id, item_id, n_matched, n_windows, n_slots``: the items that each document holds a copy of.

    ``docs`` needs ``doc_id, text`` and ``benchmark`` needs ``item_id, text``; other columns are not looked
    at.  ``n_matched`` of the item's ``n_windows`` windows are in one stretch of the document; ``n_slots``
    counts the item's slots.  An item shorter than a window is matched as a whole.  Windows of placeholders
    alone do not count, and equal windows of an item count once.

    Null, empty and blank texts, of documents or items, match nothing; rows with a null id are left out,
    having nothing to be named by.  Of repeated rows and of several stretches the best match is given
    once.  Empty tables give an empty result.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null").dropDuplicates()
    items = items.repartition(spark.sparkContext.defaultParallelism, "item_id")
    items = table(items.selectExpr("item_id", f"{_words(template('text'))} AS words", f"{_words(literal('text'))} AS plain").where("size(words) > 0"), "items")
    sizes = [r[0] for r in items.select(F.least(F.size("words"), F.lit(WINDOW)).alias("n")).distinct().collect()]
    if not sizes:
        sizes = [WINDOW]
    slim = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    texts = slim.selectExpr("doc_id", f"{_words(template('text'))} AS words", f"{_words(literal('text'))} AS plain")

    kinds = ("words", "plain")
    whole = items.selectExpr("item_id", "words", *(f"CASE least(size(words), {WINDOW}) " + " ".join(f"WHEN {n} THEN {_windows(n, x)}" for n in sizes) + f" END AS {x}_windows" for x in kinds))
    # A window of slots alone says nothing, and of an item's equal windows the first stands for all.
    says = f"filter(words_windows, x -> exists(slice(words, x.at + 1, {WINDOW}), w -> w NOT IN ('<num>', '<name>', '<unit>')))"
    marks = whole.selectExpr("item_id", f"inline(concat({says}, plain_windows))").groupBy("item_id", F.col("h").alias("item_h")).agg(F.min("at").alias("item_at"))
    marks = marks.join(marks.groupBy("item_id").agg(F.count_distinct("item_at").alias("n_windows")), "item_id")
    marks = table(marks.select("item_id", F.col("n_windows").cast("int").alias("n_windows"), "item_h", "item_at"), "marks")
    if marks.count() <= BROADCAST_WINDOWS:
        marks = F.broadcast(marks)
    pairs = [f"if(size({x}) < 2, array(), transform(sequence(0, size({x}) - 2), i -> xxhash64({x}[i], {x}[i + 1])))" for x in kinds]
    begins = [r[0] for r in items.selectExpr(f"explode(concat({', '.join(pairs)})) AS pair").distinct().limit(MOST_PAIRS + 1).collect()]
    begins = sorted(begins) or [0] if len(begins) <= MOST_PAIRS else None
    found = texts.selectExpr("doc_id", "inline(concat(" + ", ".join(_windows(n, x, begins) for n in sizes for x in kinds) + "))")
    found = found.join(marks, F.col("h") == F.col("item_h"))
    # A diagonal: the windows that lie as far into the document as the item's own do from its beginning.
    diagonal = found.groupBy("doc_id", "item_id", "n_windows", (F.col("at") - F.col("item_at")).alias("begin")).agg(F.collect_set("item_at").alias("ats"))
    # Where words were put in or left out a copy goes on in another diagonal.  Those of a stretch begin
    # within half an item; cells are as wide as the item and overlap by half, so that one holds them all.
    slots = items.selectExpr("item_id", "size(words) AS n_words", "plain AS item_plain", "transform(filter(transform(words, (w, i) -> struct(w, i)), x -> x.w IN ('<num>', '<name>')), x -> x.i) AS slots")
    cell = "floor(begin / greatest(1, n_words div 2))"
    cells = diagonal.join(slots.select("item_id", "n_words"), "item_id").selectExpr("doc_id", "item_id", "n_windows", "struct(-size(ats) AS less, begin, ats) AS part", f"explode(array({cell}, {cell} - 1)) AS cell")
    cells = cells.groupBy("doc_id", "item_id", "n_windows", "cell").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    # The diagonals of a cell together, and each of them alone; those that hold most windows come first.
    stretch = cells.selectExpr("doc_id", "item_id", "n_windows", "explode(array_distinct(concat(array(parts), transform(parts, p -> array(p))))) AS parts")
    stretch = stretch.selectExpr("doc_id", "item_id", "n_windows", "parts", "size(array_distinct(flatten(parts.ats))) AS n_matched")
    stretch = stretch.where(F.lit(100) * F.col("n_matched") >= F.lit(least_share) * F.col("n_windows"))

    # Documents with such a stretch are few: unless there are too many, texts are not shuffled to them.
    stretch = table(stretch, "stretches")
    near = slim.join(F.broadcast(stretch) if stretch.count() <= BROADCAST_STRETCHES else stretch, "doc_id").join(slots, "item_id")
    near = near.selectExpr("doc_id", "item_id", "n_matched", "n_windows", "slots", "item_plain", f"{_words(literal('text'))} AS plain", f"{PLACES} AS places")
    pairs = "transform(filter(places, x -> get(plain, x.at) IS NOT NULL), x -> struct(get(item_plain, x.s) AS ours, get(plain, x.at) AS theirs))"
    judged = near.selectExpr("doc_id", "item_id", "n_matched", "n_windows", "size(slots) AS n_slots", f"array_distinct({pairs}) AS pairs")
    judged = judged.where("size(pairs) = size(array_distinct(transform(pairs, p -> p.ours)))")
    return judged.groupBy("doc_id", "item_id").agg(
        F.max("n_matched").cast("long").alias("n_matched"), F.max("n_windows").cast("long").alias("n_windows"), F.max("n_slots").cast("long").alias("n_slots")
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op8: the benchmark items in every document."""
    return find_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
