"""Benchmark decontamination by templates: numbers, names and units become typed placeholders.

Texts become words in which a placeholder stands for every number, unit after
a number, and capitalised word within a sentence. Windows of ``WINDOW`` words
are hash-joined with the benchmark's, and so are windows of the words as they
are, without case, which find copies of items with hardly a literal word. Where
an item has placeholders, it is judged along each alignment: the windows found
must have ``LITERAL`` literal words between them, and each value of the item
must stand for one value of the document and the other way round, so a
question with other numbers and names is found, a chance likeness is not. A
run of ``RUN`` neighbouring windows of plain words is an excerpt of the item.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger.session import materialize

WINDOW = 6
LITERAL = 3  # words along an alignment that must not be placeholders
COVERED = 0.4  # of an item's windows, at least
RUN = 8  # neighbouring windows that are an excerpt, however long the item is
NUMBER, UNIT, NAME, POINT = "ⓝ", "ⓤ", "ⓐ", "ⓓ"
# Units recognised right after a number.
UNITS = (
    "km|cm|mm|kg|mg|lb|lbs|oz|ml|mph|kmh|kwh|miles?|met(?:re|er)s?|lit(?:re|er)s?|feet|foot|inch(?:es)?|hours?|minutes?|"
    "seconds?|days?|weeks?|months?|years?|dollars?|euros?|pounds?|cents?|percent|degrees?"
)
SEPARATOR = f"[^\\p{{L}}\\p{{N}}{NUMBER}{UNIT}{NAME}{POINT}]+"
# A capitalised word within a sentence, to its end or to a digit: McDonald and YouTube are one name.
# What stands before it is looked up after the capital is met, as few letters are capitals.
NAMED = "\\p{Lu}(?<=[\\p{L}\\p{N},;:)] \\p{Lu})\\p{Ll}[\\p{L}\\p{N}&&[^0-9]]*"
# Placeholder signs in a text are no placeholders; the small form of İ would be cut in two.
SIGNS = f"{NUMBER}{UNIT}{NAME}{POINT}ⓃⓊⒶⒹİ"


def _without_signs(text: Column) -> Column:
    return F.when(text.rlike(f"[{SIGNS}]"), F.translate(text, SIGNS, " " * 8 + "I")).otherwise(text)


def template_words(text: Column, values: bool = False) -> Column:
    """The words of a text's template; with ``values`` each placeholder is followed by what it stands for."""
    kept = "$0" if values else ""
    named = F.regexp_replace(_without_signs(text), NAMED, NAME + kept)
    whole = F.regexp_replace(named, ",(?<=[0-9],)(?=[0-9]{3}(?![0-9]))", "")  # 1,250 is 1250, 3.5 is not 35
    joined = F.regexp_replace(whole, "[.,](?<=[0-9].)(?=[0-9])", POINT)
    united = F.regexp_replace(joined, f"([0-9] ?)((?:{UNITS})(?!\\p{{L}})|(?<=[0-9])%)", f"$1 {UNIT}{'$2' if values else ''} ")
    counted = F.regexp_replace(united, f"[0-9](?:{POINT}?[0-9])*", f" {NUMBER}{kept} ")
    words = F.split(F.lower(F.when(text.rlike("[0-9]"), counted).otherwise(named)), SEPARATOR)
    return F.filter(words, lambda w: w != "")


def plain_words(text: Column) -> Column:
    """The words of a text as they are, without case."""
    # signs part words here as spaces do, so only the letter that would be cut in two is replaced
    return F.filter(F.split(F.lower(F.replace(text, F.lit("İ"), F.lit("I"))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def kind_of(word: Column) -> Column:
    """A word of a template with values, without its value."""
    return F.when(word.rlike(f"^[{NUMBER}{UNIT}{NAME}]"), F.substring(word, 1, 1)).otherwise(word)


def _is_slot(word: Column) -> Column:
    return word.isin(NUMBER, UNIT, NAME)


def window_hashes(words: Column, width: int = WINDOW) -> Column:
    """The hash of the window that starts at each word; none where there are fewer words."""
    starts = F.sequence(F.lit(0), F.size(words) - width)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    return F.when(F.size(words) >= width, hashes).otherwise(F.array().cast("array<long>"))


def _by_width() -> Column:
    """The hashes of the windows of ``words``, each as long as ``width`` says."""
    return reduce(
        lambda found, w: found.when(F.col("width") == w, window_hashes(F.col("words"), w)), range(1, WINDOW), F.when(F.lit(False), None)
    ).otherwise(window_hashes(F.col("words")))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Rows (item_id, item_text, plain, width, hash, item_pos, n_windows, slots, literals) of the windows of each id and text.

    ``slots`` are the placeholders with their values, ``literals`` the places
    of the other words. Windows of nothing but placeholders are left out.
    Items shorter than a window are one window.
    """
    item = ["item_id", "item_text", "plain"]
    texts = benchmark.select("item_id", "text").distinct().withColumn("item_text", F.xxhash64("text"))
    template = texts.select("item_id", "item_text", F.lit(False).alias("plain"), template_words(F.col("text"), values=True).alias("valued"))
    template = template.withColumn("words", F.transform("valued", kind_of))
    plain = texts.select("item_id", "item_text", F.lit(True).alias("plain"), plain_words(F.col("text")).alias("valued")).withColumn("words", F.col("valued"))
    sized = template.union(plain).withColumn("width", F.least(F.size("words"), F.lit(WINDOW))).filter("width > 0")
    placed = sized.select(*item, "width", "valued", F.posexplode(_by_width()).alias("item_pos", "hash"))
    span = F.arrays_zip(F.sequence("item_pos", F.col("item_pos") + F.col("width") - 1).alias("at"), _window_of("item_pos").alias("word"))
    literals = F.transform(F.filter(span, lambda w: ~_is_slot(F.substring(w["word"], 1, 1))), lambda w: w["at"])
    told = placed.select(*item, "width", "hash", "item_pos", _slots_of("item_pos").alias("slots"), literals.alias("literals")).filter(F.size("literals") > 0)
    return told.withColumn("n_windows", F.count("*").over(Window.partitionBy(*item)))  # one item's windows


def _window_of(pos: str) -> Column:
    return F.slice("valued", F.col(pos) + 1, F.col("width"))


def _slots_of(pos: str) -> Column:
    """The placeholders of a window with what they stand for."""
    return F.filter(_window_of(pos), lambda w: _is_slot(F.substring(w, 1, 1)))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows (doc_id, text_hash, item_id, n_matched, n_windows, covered) of documents that hold a benchmark item.

    An item is held if at least ``COVERED`` of the windows of its plain words
    are found, or of its template without placeholders in them, or ``RUN``
    neighbouring ones along an alignment. A template with placeholders is held
    if as many windows are found, and they stand for values one to one and
    between ``LITERAL`` literal words, along an alignment that has as many of
    the windows or along one of those with most windows. The figures are of
    the template where it is held. An item of fewer words than a window is one
    window. Texts of one id are judged one by one, the best of them counts.
    Items without words are never held; null or empty texts hold nothing; null
    ids are kept, rows equal in id and text count once; other columns are not
    read; empty tables give an empty result.
    """
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    windows = materialize(item_windows(benchmark.select("item_id", "text")), "item-windows")
    side = ["item_id", "item_text", "plain", "width"]
    # The size of the written table decides whether the benchmark's side is sent to all tasks.
    known = materialize(windows.groupBy(*side, "hash", "n_windows").agg(
        F.count("*").alias("n_here"), F.max(F.size("slots") > 0).alias("slotted")), "item-hashes")
    widths: dict[bool, list[int]] = {False: [], True: []}
    for r in known.select("plain", "width").distinct().orderBy("width").collect():  # at most twice WINDOW
        widths[r["plain"]].append(r["width"])
    found = _found_windows(texts, widths)
    pair = ["doc_id", "text_hash", "item_id", "item_text", "plain"]
    met = found.join(known, ["plain", "width", "hash"]).dropDuplicates([*pair, "width", "hash"])
    held = met.groupBy(*pair, "n_windows").agg(F.sum("n_here").alias("n_matched"), F.max("slotted").alias("slotted"))
    held = held.withColumn("covered", F.least(F.col("n_matched") / F.col("n_windows"), F.lit(1.0)))
    likely = materialize(held.filter((F.col("covered") >= COVERED) | (F.col("n_matched") >= RUN)), "likely-leaks")
    sure = (F.col("covered") >= COVERED) & ~F.col("slotted")
    aligned = materialize(_aligned(texts, windows, widths, likely.filter(~sure).select(*pair)), "aligned-leaks")
    agreeing = likely.filter(~sure).alias("l").join(aligned.alias("r"), _same(pair), "left_semi")
    figures = F.struct("n_matched", "n_windows", "covered")
    best = F.max_by(figures, F.struct(~F.col("plain"), F.col("covered"), F.col("n_windows")))
    each = likely.filter(sure).union(agreeing).groupBy("doc_id", "text_hash", "item_id").agg(best.alias("figures"))
    return each.select("doc_id", "text_hash", "item_id", "figures.*")


def _windows(texts: DataFrame, widths: dict[bool, list[int]], values: bool = False) -> DataFrame:
    """Rows (doc_id, text_hash, plain, width, hashes) of each document's template and plain words; with ``values`` their words too."""
    template = template_words(F.col("text"), values)
    words = texts.withColumns({"template": template, "plain_words": plain_words(F.col("text"))})
    words = words.withColumn("kinds", F.transform("template", kind_of) if values else F.col("template"))
    more = {False: ["template"], True: ["plain_words"]} if values else {False: [], True: []}
    each = [
        F.struct(F.lit(plain).alias("plain"), F.lit(w).alias("width"), window_hashes(F.col("plain_words" if plain else "kinds"), w).alias("hashes"),
                 *[F.col(c).alias("valued") for c in more[plain]])
        for plain in (False, True) for w in widths[plain] or [WINDOW]
    ]
    return words.select("doc_id", "text_hash", F.explode(F.array(*each)).alias("w")).select("doc_id", "text_hash", "w.*")


def _found_windows(texts: DataFrame, widths: dict[bool, list[int]]) -> DataFrame:
    """Rows (doc_id, text_hash, plain, width, hash) of the windows of each document, of its template and of its plain words."""
    return _windows(texts, widths).select("doc_id", "text_hash", "plain", "width", F.explode(F.array_distinct("hashes")).alias("hash"))


def _same(columns: list[str]) -> Column:
    """Both sides equal in these columns, nulls included."""
    return reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in columns])


def _aligned(texts: DataFrame, windows: DataFrame, widths: dict[bool, list[int]], pairs: DataFrame) -> DataFrame:
    """The pairs held along an alignment: by placeholders that agree, or by a run of plain windows."""
    document = ["doc_id", "text_hash"]
    pair = [*document, "item_id", "item_text", "plain"]
    own = texts.alias("l").join(pairs.select(*document).distinct().alias("r"), _same(document), "left_semi")
    own = own.dropDuplicates(document)
    placed = _windows(own, widths, values=True).select(*document, "plain", "width", "valued", F.posexplode("hashes").alias("pos", "hash"))
    met = placed.join(windows, ["plain", "width", "hash"]).select(
        *pair, "n_windows", "pos", "item_pos", "slots", "literals", _slots_of("pos").alias("here"))
    met = met.alias("l").join(pairs.alias("r"), _same(pair), "left_semi")
    aligned = met.groupBy(*pair, "n_windows", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.count("*").alias("n"),
        # At most one element a word or window of the item: sets of what is on one alignment.
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("slots", "here")))).alias("pairs"),
        F.size(F.array_distinct(F.flatten(F.collect_set("literals")))).alias("literal"),
        F.array_sort(F.collect_set("item_pos")).alias("at"),
    )
    theirs, ours = (F.size(F.array_distinct(F.col(f"pairs.{c}"))) for c in ("slots", "here"))
    agrees = (theirs == F.size("pairs")) & (ours == F.size("pairs")) & (F.col("literal") >= LITERAL)
    # positions less their rank are equal along a run, so the window RUN - 1 further on tells one
    runs = F.exists(F.sequence(F.lit(0), F.size("at") - RUN), lambda i: F.get("at", i + (RUN - 1)) - F.get("at", i) == RUN - 1)
    run = agrees & F.when(F.size("at") >= RUN, runs).otherwise(False)
    best = aligned.groupBy(*pair, "n_windows").agg(
        F.max("n").alias("most"), F.max(F.when(agrees, F.col("n"))).alias("agreed"), F.max(run).alias("run"), F.sum("n").alias("all"))
    enough = (F.col("agreed") / F.col("n_windows") >= COVERED) | (
        (F.col("agreed") == F.col("most")) & (F.col("all") / F.col("n_windows") >= COVERED))
    return best.filter(F.col("run") | (~F.col("plain") & enough)).select(*pair)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns are kept."""
    leaks = contaminated(docs, benchmark).select(F.col("doc_id").alias("leak"), F.col("text_hash").alias("leak_hash"))
    leaks = materialize(leaks.distinct(), "leaks")
    same = docs["doc_id"].eqNullSafe(leaks["leak"]) & (F.xxhash64(docs["text"]) == leaks["leak_hash"])
    return docs.join(leaks, same, "left_anti")
