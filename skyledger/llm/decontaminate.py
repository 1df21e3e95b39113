"""Benchmark decontamination by templates: finds re-parameterised copies of benchmark items in documents.

A text is read in three forms. As a *template*, numbers, units after numbers and names inside sentences turn
into typed placeholders, all other words lose case and punctuation (``canonical``). As an *open* template, each
run of words with a capital is one name, also where a sentence starts or all letters are capitals, and an
amount with its unit is one number (``glued``). As *folded* words nothing is replaced: exact copies in any case.

Windows of ``WINDOW`` words of each form are hashed, and the windows of all documents joined with those of
the benchmark. Matches of one document, item and form that lie on one diagonal (equal distance of positions)
belong together. A diagonal counts when at least half of the item's windows that are searched match, or
``ENOUGH`` of them, and when its slots are consistent: along the diagonal each value in a slot of the item
stands for one value in the document, and each of the document's for one of the item. Items with one
template and one pattern of equal slots are reported once; each of their open and folded forms is searched.

Making the forms is dear, so it is done only for texts that can hold an item (``near``). Each searched window
has literal words; a text whose template, open or folded form holds it has them too, as folded words, and those
that stand side by side do so there. One run of at most ``ANCHOR`` of them is the window's anchor, and a text
without any anchor matches nothing. Of an item's n windows of which m must match, the best n - m + 1 are asked
for. Only the open form has literal words that are no folded words: runs of names that end in a word like
"U.S."; they are looked up by themselves (``glued_literals``). The filter is exact: it moves no result.

Only DataFrame functions are used. The benchmark's windows are broadcast if there are at most
``BROADCAST_WINDOWS`` of them, counted first; beyond that the join shuffles, and every text is read in all forms.

Edge cases: NULL and empty texts have no words. An item shorter than a window is one window of its own
length. An item of fewer than ``LEAST_WORDS`` words, or a window with fewer literal words than
``LEAST_LITERALS``, is searched in the folded form only. A name written without any capital is a literal.
Documents that repeat an id count as one. A NULL doc_id or item_id is
reported as NULL. Of items with one template the smallest item_id is reported, with their number. Extra columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.store import staged

WINDOW = 8
LEAST_WORDS = 4
LEAST_LITERALS = 3
ENOUGH = 6
ANCHOR = 3
BROADCAST_WINDOWS = 1_000_000
NUMBER, UNIT, NAME = "<0>", "<u>", "<n>"
TEMPLATE, OPEN, FOLDED = "template", "open", "folded"
GLUE = "\u203f"
QUIET = r"[^\p{L}\p{N}\s]*+"

# Number words and unit words.
NUMBER_WORDS = (
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million"
)
UNIT_WORDS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons "
    "pound pounds lb lbs ounce ounces oz ml l liter liters litre litres gallon gallons second seconds minute "
    "minutes min hour hours h day days week weeks month months year years percent degree degrees dollar "
    "dollars cent cents euro euros mph kmh watt watts volt volts newton newtons joule joules meter meters "
    "metre metres centimeter centimeters kilometer kilometers"
)


def either(words: str) -> str:
    return "|".join(words.split())


def spaced(text: Column) -> Column:
    """Words apart by one space; runs without a letter or digit are no words."""
    text = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?<!\S)[^\p{L}\p{N}\s]++(?!\S)", " ")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def canonical(words: Column, open_: bool = False) -> Column:
    """Template of a spaced text: as many words, placeholders for numbers, units and names. ``open_``: of a
    glued text, in which each word with a capital is a name."""
    glue = rf"(?:{GLUE}(?:{either(UNIT_WORDS)}))?" if open_ else ""
    amount = rf"(?<!\S){QUIET}[0-9][0-9.,:/-]*+(?:{either(UNIT_WORDS)}|%|°)?{glue}{QUIET}(?!\S)"
    number_word = rf"(?i)(?<!\S){QUIET}(?:{either(NUMBER_WORDS)}){glue}{QUIET}(?!\S)"
    out = F.regexp_replace(words, amount, NUMBER)
    out = F.regexp_replace(out, number_word, NUMBER)
    if open_:
        out = F.regexp_replace(out, rf"(?<!\S){QUIET}\p{{Lu}}[\p{{L}}\p{{M}}'{GLUE}-]*+{QUIET}(?!\S)", NAME)
    else:
        unit = rf"(?i)(?<={NUMBER}) {QUIET}(?:{either(UNIT_WORDS)}){QUIET}(?!\S)"
        out = F.regexp_replace(out, unit, f" {UNIT}")
        # A capital inside a sentence: the word before does not end one.
        name = rf"(?<=[^\s.!?:;] ){QUIET}\p{{Lu}}[\p{{Ll}}\p{{M}}'-]++{QUIET}(?!\S)"
        out = F.regexp_replace(out, name, NAME)
    return F.lower(F.regexp_replace(out, r"[^\p{L}\p{N}<> ]+|<(?![0un]>)|(?<!<[0un])>", ""))


def glued(words: Column) -> Column:
    """A spaced text in which runs of words with capitals, and amounts with their units, are one word."""
    units = rf"(?=(?:{either(UNIT_WORDS)}){QUIET}(?!\S))"
    out = F.regexp_replace(words, rf"(?<!\S)({QUIET}[0-9][0-9.,:/-]*+) {units}", f"$1{GLUE}")
    out = F.regexp_replace(out, rf"(?i)(?<!\S)({QUIET}(?:{either(NUMBER_WORDS)})) {units}", f"$1{GLUE}")
    return F.regexp_replace(out, rf"(?<!\S)({QUIET}\p{{Lu}}[\p{{L}}\p{{M}}'-]*+) (?={QUIET}\p{{Lu}})", f"$1{GLUE}")


def forms(text: Column) -> dict[str, tuple[Column, Column]]:
    """Of a spaced text: the words of each form, and what is hashed of them."""
    folded = F.lower(F.regexp_replace(text, r"[^\p{L}\p{N} ]+", ""))
    made = {TEMPLATE: (text, canonical(text)), OPEN: (glued(text), canonical(glued(text), True)), FOLDED: (text, folded)}
    return {form: (F.split(words, " "), F.split(hashed, " ")) for form, (words, hashed) in made.items()}


def plain(word: Column) -> Column:
    """A slot's value: the word without case and punctuation around it; of a run of names the last, as a
    sentence's first word may be no name."""
    last = F.regexp_replace(word, rf"^.*{GLUE}(?=[^\p{{L}}\p{{N}}]*\p{{Lu}})", "")
    return F.lower(F.regexp_replace(last, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))


def window_hashes(words: Column, size: int) -> Column:
    """Hashes of the windows of ``size`` words, in order."""
    n = F.size(words) - (size - 1)
    each = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, size)))
    return F.when(n > 0, each)


def is_slot(word: Column) -> Column:
    return word.isin(NUMBER, UNIT, NAME)


def templates(benchmark: DataFrame) -> DataFrame:
    """One row per template and pattern of equal slots, form and text of that form: pattern, item_id,
    n_items, form, entry, template, item_words."""
    own = benchmark.select("item_id", spaced(F.col("text")).alias("spaced")).filter("spaced <> ''")
    made = [
        F.struct(F.lit(form).alias("form"), words.alias("item_words"), template.alias("template"))
        for form, (words, template) in forms(F.col("spaced")).items()
    ]
    own = own.select("item_id", F.array(*made).alias("forms"))

    def pattern(form: Column) -> Column:
        values = F.transform(form["item_words"], plain)
        slots = F.transform(form["template"], lambda w, i: F.when(is_slot(w), F.array_position(values, values[i])))
        return F.xxhash64(form["template"], slots)

    own = own.withColumn("pattern", pattern(F.col("forms")[0]))
    groups = own.groupBy("pattern").agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items"))
    each = own.select("pattern", "item_id", F.explode("forms").alias("own"))
    each = each.withColumn("entry", F.xxhash64("pattern", "own.form", pattern(F.col("own"))))
    each = each.groupBy("pattern", "entry").agg(F.min_by("own", F.struct("item_id")).alias("own"))
    return each.join(groups, "pattern").select("pattern", "item_id", "n_items", "entry", "own.*")


def item_windows(items: DataFrame) -> DataFrame:
    """hash, size, form, entry, item_at, n_windows, slotted of every window searched."""
    own = items.withColumn("size", F.least(F.size("template"), F.lit(WINDOW)))
    n_slots = lambda at: F.size(F.filter(F.slice("template", at, F.col("size")), is_slot))
    # Windows without enough literal words are found as folded words only.
    searched = lambda at: (F.col("form") == FOLDED) | (
        (F.size("template") >= LEAST_WORDS) & (F.col("size") - n_slots(at) >= LEAST_LITERALS)
    )
    at = F.filter(F.sequence(F.lit(1), F.size("template") - F.col("size") + 1), searched)
    own = own.withColumn("searched", at).withColumn("item_at", F.explode("searched"))
    return own.select(
        F.xxhash64(F.slice("template", F.col("item_at"), F.col("size"))).alias("hash"), "size", "form", "entry",
        "item_at", F.size("searched").alias("n_windows"), (n_slots(F.col("item_at")) > 0).alias("slotted"),
    )


def needed(n_windows: Column) -> Column:
    """How many of an item's searched windows must match."""
    return F.least(F.ceil(n_windows / 2), F.lit(ENOUGH))


def fold(text: Column, but: str = "") -> Column:
    """The text without case and without all but letters, digits and ``but``."""
    return F.lower(F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}{but}]+", ""))


def anchors(items: DataFrame, windows: DataFrame) -> DataFrame:
    """key, before, gram: of each run of words to look for the hash of the longest word, how many stand before
    it, and all of them."""
    own = windows.select("entry", "item_at", "n_windows", "size").join(items.select("entry", "template"), "entry")
    own = own.withColumn("literals", F.transform(F.slice("template", F.col("item_at"), F.col("size")), literal))

    def run(first: Column) -> Column:
        words = F.slice("literals", first, ANCHOR)
        end = F.coalesce(F.nullif(F.array_position(F.transform(words, lambda w: w.isNull()), True), F.lit(0)), F.size(words) + 1)
        words = F.slice(words, 1, (end - 1).cast("int"))
        letters = F.aggregate(words, F.lit(0), lambda n, w: n + F.length(w))
        return F.struct(F.size(words).alias("n"), letters.alias("letters"), words.alias("gram"))

    runs = F.transform(F.sequence(F.lit(1), F.size("literals")), run)
    own = own.withColumn("best", F.array_max(runs))
    rank = F.row_number().over(Window.partitionBy("entry").orderBy(F.desc("best"), "item_at"))
    own = own.withColumn("rank", rank).filter(F.col("rank") <= F.col("n_windows") - needed(F.col("n_windows")) + 1)
    own = own.select("best.gram").distinct()
    longest = F.array_max(F.transform("gram", lambda w, i: F.struct(F.length(w).alias("letters"), w.alias("word"), i.alias("at"))))
    own = own.select("gram", longest.alias("longest"))
    return own.select(F.xxhash64("longest.word").alias("key"), F.col("longest.at").alias("before"), "gram")


def literal(word: Column) -> Column:
    """A word of a template as folded word; NULL for a slot."""
    return F.when(~is_slot(word), fold(word))


def glued_literals(text: Column) -> Column:
    """The last two words, folded, of each run of names that is one literal word of the open form: its last
    word is no name, as in "New U.S."."""
    name = r"\p{Lu}[\p{L}\p{M}'-]*+"
    found = F.regexp_extract_all(
        text, F.lit(rf"{name}\s+(?:[^\p{{L}}\p{{N}}\s]++\s+)*+{QUIET}{name}(?!{QUIET}(?!\S))\S+"), F.lit(0)
    )
    return F.transform(found, fold)


def near(docs: DataFrame, items: DataFrame, windows: DataFrame) -> DataFrame:
    """The documents that hold an anchor, among them all with enough matching windows."""
    text = F.coalesce("text", F.lit(""))
    words = docs.select("doc_id", F.split(fold(text, r"\s"), r"\s+").alias("words"))
    words = words.select("doc_id", "words", F.posexplode("words").alias("at", "word"))
    asked = F.broadcast(staged(anchors(items, windows), "anchors"))
    at = F.slice("words", F.col("at") - F.col("before") + 1, F.size("gram")) == F.col("gram")
    hits = words.join(asked, F.xxhash64("word") == F.col("key")).filter((F.col("at") >= F.col("before")) & at)

    # Words that a glued word can end with: the ends of the open form's literal words.
    own = items.filter(F.col("form") == OPEN).select(F.explode(F.transform("template", literal)).alias("word")).distinct()
    ends = own.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.substr("word", i))).alias("end"))
    ends = F.broadcast(staged(ends.distinct(), "ends"))
    glued_ = docs.select("doc_id", F.explode(glued_literals(text)).alias("end")).join(ends, "end")
    ids = staged(hits.select("doc_id").union(glued_.select("doc_id")).distinct(), "near-ids")
    ids = ids.withColumnRenamed("doc_id", "near_id")
    return staged(docs.join(ids, F.col("doc_id").eqNullSafe(F.col("near_id")), "left_semi"), "near")


def matches(docs: DataFrame, items: DataFrame, windows: DataFrame) -> DataFrame:
    """Diagonals of documents and items with enough matching windows."""
    found = windows.groupBy("form", "size").count().collect()  # one row per form and window size
    own = docs.select("doc_id", spaced(F.col("text")).alias("spaced"))
    hits = []
    for form, size in sorted((r["form"], r["size"]) for r in found):
        hashes = window_hashes(F.col("words"), size)
        each = own.select("doc_id", forms(F.col("spaced"))[form][1].alias("words"))
        each = each.select("doc_id", F.posexplode(hashes).alias("doc_at", "hash"))
        own_size = windows.filter((F.col("size") == size) & (F.col("form") == form)).drop("size", "form")
        hits.append(each.join(own_size, "hash").drop("hash"))
    if not hits:
        hits = [own.select("doc_id", F.lit(0).alias("doc_at")).join(windows.drop("size", "form", "hash"), F.lit(False))]
    hit = reduce(DataFrame.union, hits)
    diagonal = (F.col("doc_at") + 1 - F.col("item_at")).alias("diagonal")
    return (
        hit.select("doc_id", "entry", "item_at", "n_windows", "slotted", diagonal)
        .distinct()
        .groupBy("doc_id", "entry", "diagonal", "n_windows")
        .agg(F.count("*").alias("n_matched"), F.max("slotted").alias("slotted"), F.collect_list("item_at").alias("at"))
        .filter(F.col("n_matched") >= needed(F.col("n_windows")))
    )


def inconsistent(docs: DataFrame, items: DataFrame, found: DataFrame) -> DataFrame:
    """Of the diagonals with slots, those whose slots are not consistent."""
    texts = docs.select(F.col("doc_id").alias("text_id"), spaced(F.col("text")).alias("spaced"))
    own = found.filter("slotted").join(items.select("entry", "form", "template", "item_words"), "entry")
    # The item's positions that the matched windows cover, and what stands there on both sides.
    covered = F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a, a + (WINDOW - 1)))))
    covered = F.filter(covered, lambda p: p <= F.size("template"))
    slots = F.filter(covered, lambda p: is_slot(F.element_at("template", p)))
    own = own.select("doc_id", "entry", "diagonal", "form", "item_words", slots.alias("slots"))
    both = own.join(texts, F.col("doc_id").eqNullSafe(F.col("text_id")))
    words = F.split(F.when(F.col("form") == OPEN, glued(F.col("spaced"))).otherwise(F.col("spaced")), " ")
    both = both.withColumn("words", words)
    pair = F.transform(
        "slots",
        lambda p: F.struct(
            plain(F.element_at("item_words", p)).alias("item"),
            plain(F.try_element_at("words", (p + F.col("diagonal")).cast("int"))).alias("doc"),
        ),
    )
    pairs = both.select("doc_id", "entry", "diagonal", F.array_distinct(pair).alias("pairs"))
    n = F.size("pairs")
    one_to_one = (F.size(F.array_distinct(F.col("pairs.item"))) == n) & (F.size(F.array_distinct(F.col("pairs.doc"))) == n)
    return pairs.groupBy("doc_id", "entry", "diagonal").agg(F.max(one_to_one).alias("fits")).filter(~F.col("fits"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_items, n_windows, n_matched: documents that hold an item or a variant of it."""
    items = staged(templates(benchmark), "templates")
    windows = staged(item_windows(items), "windows")
    if windows.count() <= BROADCAST_WINDOWS:
        docs = near(docs.select("doc_id", "text"), items, windows)
        windows = F.broadcast(windows)
    found = staged(matches(docs, items, windows), "diagonals")
    if found.filter("slotted").limit(1).count():
        bad = inconsistent(docs, items, found).withColumnsRenamed({"doc_id": "d", "entry": "e", "diagonal": "g"})
        same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("entry") == F.col("e"))
        found = found.join(bad, same & (F.col("diagonal") == F.col("g")), "left_anti")
    best = found.join(items.select("entry", "pattern", "item_id", "n_items"), "entry")
    # The form that matches most, by its share of the windows searched.
    most = F.struct((F.col("n_matched") / F.col("n_windows")).alias("share"), "n_matched", "n_windows")
    return (
        best.groupBy("doc_id", "pattern", "item_id", "n_items").agg(F.max(most).alias("most"))
        .select("doc_id", "item_id", "n_items", "most.n_windows", "most.n_matched")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones."""
    bad = staged(contaminated(docs, benchmark).select(F.col("doc_id").alias("bad_id")).distinct(), "contaminated")
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("bad_id")), "left_anti")


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Contaminated documents with the benchmark items they hold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
