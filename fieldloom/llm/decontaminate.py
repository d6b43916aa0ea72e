"""Benchmark decontamination by templates, in DataFrame operations only.

Numbers, names and units become typed placeholders; windows of canonical tokens are hash-joined
with those of the benchmark.  Matches along one alignment must then agree on what fills the slots:
each benchmark value may stand for one document value only and the other way round.  That finds a
question asked again with other numbers or names, and rejects chance matches of a bare template.
A slot that disagrees takes only the windows over it away, so one edited number does not hide a copy.

Texts are compared in two forms, and either finds a leak: ``LITERAL`` leaves names as lower-case words,
so that copies in another case match; ``TEMPLATE`` makes every capitalised word a name, also at the
start of a sentence or line.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fresh, row_key

#: Units that may follow a number.
UNITS = "kg|km|mm|cm|ml|mg|lb|oz|ft|mi|mph|kph|hours?|minutes?|seconds?|days?|weeks?|months?|years?|meters?|metres?|miles?|grams?|litres?|liters?|dollars?|euros?|cents?|percent|degrees?"
# Possessive: Java recurses for each turn of another repeated group, and some thousand names in a row would overflow the stack.
NAMES = r"(?<![\p{L}\p{M}\p{Nd}])(\p{Lu}\p{Ll}++(?: \p{Lu}\p{Ll}++)*+)"
NUMBERS = r"([0-9]++(?:[.,][0-9]++)*+)"
#: Rows that may be broadcast; larger sides are shuffled.
BROADCAST_ROWS = 500_000
LITERAL, TEMPLATE = 0, 1
#: Words that a template must keep besides its placeholders; with fewer it would match by chance.
LEAST_WORDS = 3


def squeezed(text: Column) -> Column:
    """One plain space for each run of white space; an empty line also ends a name."""
    return F.regexp_replace(F.regexp_replace(text, r"\n[^\S\n]*\n", "\n.\n"), r"[\s\p{Z}]+", " ")


def canonical(text: Column, form: int) -> Column:
    """Tokens of a squeezed text in lower case, with ``\\x01n``, ``\\x01d`` and ``\\x01u`` for names, numbers, units."""
    x = F.regexp_replace(text, NAMES, " \x01n ") if form == TEMPLATE else text
    x = F.regexp_replace(x, NUMBERS, " \x01d ")
    x = F.regexp_replace(x, rf"(\x01d  ?)(?i:{UNITS})\b", "$1 \x01u ")
    # Each step stands once in the expression, so that nothing is computed twice.
    return F.coalesce(F.array_remove(F.split(F.lower(x), r"[^\p{L}\p{M}\x01]+"), ""), F.array().cast("array<string>"))


def slot_values(text: Column, form: int) -> Column:
    """What the placeholders of :func:`canonical` stand for, in order."""
    x = F.regexp_replace(text, NAMES, " \x01$1\x02 ") if form == TEMPLATE else text
    x = F.regexp_replace(x, NUMBERS, " \x01$1\x02 ")
    x = F.regexp_replace(x, rf"(\x01[0-9.,]+\x02  ?)((?i:{UNITS}))\b", "$1 \x01$2\x02 ")
    return F.transform(F.regexp_extract_all(x, F.lit("\x01([^\x02]*)\x02"), 1), F.lower)


def _both_forms(df: DataFrame, squeezed_col: str, tokens: str) -> DataFrame:
    """Two rows for each row: ``__form`` and its tokens."""
    forms = F.array(*[F.struct(F.lit(f).alias("f"), canonical(F.col(squeezed_col), f).alias("t")) for f in (LITERAL, TEMPLATE)])
    rest = [c for c in df.columns if c != tokens]
    return df.select(*rest, F.explode(forms).alias("__x")).select(*rest, F.col("__x.f").alias("__form"), F.col("__x.t").alias(tokens))


def _of_form(f: Callable[[int], Column]) -> Column:
    """``f`` of each row's form."""
    return F.when(F.col("__form") == TEMPLATE, f(TEMPLATE)).otherwise(f(LITERAL))


def _windows(df: DataFrame, tokens: str, widths: list[int], position: str) -> DataFrame:
    """A row per window of each width: ``df`` without its tokens, and ``__w``, ``position`` (from 1) and ``__h``, which differs by form.

    Tokens are hashed once; the explode and the windows' hashes stay in generated code.
    """
    rest = [c for c in df.columns if c != tokens]
    hashed = df.where(F.size(tokens) >= min(widths)).select(*rest, F.transform(tokens, lambda t: F.xxhash64(t)).alias("__hashes"))
    last = F.size("__hashes") - min(widths) + 1
    each = hashed.select(*rest, "__hashes", F.explode(F.sequence(F.lit(1), last)).alias(position))

    def window(w: int) -> Column:
        return F.xxhash64(F.slice("__hashes", F.col(position), w), F.col("__form"))

    if len(widths) == 1:
        return each.select(*rest, F.lit(widths[0]).alias("__w"), position, window(widths[0]).alias("__h"))
    each = each.select(*rest, position, F.size("__hashes").alias("__size"), F.explode(F.array(*[F.struct(F.lit(w).alias("w"), window(w).alias("h")) for w in widths])).alias("__x"))
    return each.where(F.col(position) + F.col("__x.w") - 1 <= F.col("__size")).select(*rest, F.col("__x.w").alias("__w"), position, F.col("__x.h").alias("__h"))


def _within(df: DataFrame) -> DataFrame:
    """Broadcast a written table if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = 8, coverage: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", passage: int = 50) -> DataFrame:
    """(id, item, matched, windows, coverage, kind), one row per leaking document row and item.

    An item leaks when, in either form, at least ``coverage`` of its windows of ``width`` tokens occur in
    the text with consistent slots, or when ``passage`` tokens of it in a row do, whatever their share.
    Slots are compared along an alignment: equal values agree, and unequal ones if neither stands for a
    third value; windows over other slots do not count.  An item with fewer tokens is one window.  The
    figures are of the form with the greater coverage.  ``kind`` is "verbatim" if all its slot values are
    equal, else "re-parameterised".  Items whose template keeps under ``LEAST_WORDS`` words are looked
    for by their literal names only.  Null or empty texts and items
    match nothing; repeated document rows give one result row (equal id and text); repeated items
    count once; empty tables give an empty result; other columns are ignored.
    """
    with Scratch(docs.sparkSession, "leaks") as scratch:
        items = benchmark.select(F.col(item_col).alias("__item"), F.col(item_text_col).cast("string").alias("__itext")).where("__itext is not null").distinct()
        items = _both_forms(items.select("__item", row_key("__item", "__itext").alias("__ikey"), squeezed(F.col("__itext")).alias("__s")), "__s", "__it").where(F.size("__it") > 0)
        # Without names the template adds nothing.
        named = F.array_contains("__it", "\x01n") & (F.size(F.filter("__it", lambda t: ~F.startswith(t, F.lit("\x01")))) >= LEAST_WORDS)
        items = items.where((F.col("__form") == LITERAL) | named)
        items = items.withColumn("__w", F.least(F.lit(width), F.size("__it"))).withColumn("__iv", _of_form(lambda f: slot_values(F.col("__s"), f)))
        items = scratch.write(items.withColumn("__n", F.size("__it") - F.col("__w") + 1).drop("__s"), "items")
        widths = sorted(r[0] for r in items.select("__w").distinct().collect())  # at most ``width`` values
        empty = f"{docs.select(id_col).schema[0].dataType.simpleString()}"
        if not widths:
            return docs.sparkSession.createDataFrame([], f"{id_col} {empty}, {item_col} {benchmark.schema[item_col].dataType.simpleString()}, matched long, windows int, coverage double, kind string")

        index = _windows(items.select("__ikey", "__form", F.col("__w").alias("__own"), "__it"), "__it", widths, "__ipos").where(F.col("__w") == F.col("__own")).drop("__own")
        index = scratch.write(index, "index")

        texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text")).where("__text is not null")
        keyed = _both_forms(texts.select("__id", row_key("__id", "__text").alias("__key"), squeezed(F.col("__text")).alias("__s")), "__s", "__t")
        found = _windows(keyed.drop("__s"), "__t", widths, "__pos")
        found = found.join(_within(index), ["__h", "__w", "__form"])
        # An alignment's windows are at most an item's; identical rows collapse while still in the map.
        lines = found.groupBy("__id", "__key", "__ikey", "__form", (F.col("__pos") - F.col("__ipos")).alias("__shift")).agg(F.collect_set("__ipos").alias("__ipos"))
        lines = scratch.write(lines, "alignments").join(_within(items), ["__ikey", "__form"])

        # Item positions that the alignment covers and that are slots, and each one's ordinal.
        slots = F.filter(F.sequence(F.lit(1), F.size("__it")), lambda p: F.startswith(F.element_at("__it", p), F.lit("\x01")) & F.exists("__ipos", lambda q: (p >= q) & (p < q + F.col("__w"))))
        lines = scratch.write(lines.withColumn("__slots", F.when(F.exists("__it", lambda t: F.startswith(t, F.lit("\x01"))), slots).otherwise(F.array().cast("array<int>"))), "slots")
        kept = ["__id", "__key", "__ikey", "__form", "__item", "__n", "__w", "__ipos"]
        bare = lines.where(F.size("__slots") == 0).select(*kept, F.lit(True).alias("__same"))
        filled = lines.where(F.size("__slots") > 0)
        # Only documents with slots to compare are read again.
        wanted = scratch.write(filled.select("__key", "__form").distinct(), "wanted")
        again = texts.withColumn("__key", row_key("__id", "__text")).join(_within(wanted), "__key").dropDuplicates(["__key", "__form"])
        again = again.select("__key", "__form", squeezed(F.col("__text")).alias("__s"))
        again = again.select("__key", "__form", _of_form(lambda f: canonical(F.col("__s"), f)).alias("__t"), _of_form(lambda f: slot_values(F.col("__s"), f)).alias("__v"))
        filled = filled.join(again, ["__key", "__form"])

        def value(tokens: str, values: str, p: Column) -> Column:
            return F.try_element_at(F.col(values), F.size(F.filter(F.slice(F.col(tokens), F.lit(1), p), lambda t: F.startswith(t, F.lit("\x01")))))

        fills = F.transform("__slots", lambda p: F.struct(p.alias("p"), F.struct(value("__it", "__iv", p).alias("i"), value("__t", "__v", p + F.col("__shift")).alias("d")).alias("x")))
        filled = filled.withColumn("__fills", fills).withColumn("__pairs", F.array_distinct("__fills.x"))
        one_to_one = (F.size(F.array_distinct(F.col("__pairs.i"))) == F.size("__pairs")) & (F.size(F.array_distinct(F.col("__pairs.d"))) == F.size("__pairs"))
        equal = lambda x: x["i"].eqNullSafe(x["d"])
        clash = F.filter("__pairs", lambda x: ~equal(x) & F.exists("__pairs", lambda y: y["i"].eqNullSafe(x["i"]) != y["d"].eqNullSafe(x["d"])))
        filled = filled.withColumn("__clash", F.when(~one_to_one, clash).otherwise(F.slice("__pairs", 1, 0)))
        filled = filled.withColumn("__bad", F.transform(F.filter("__fills", lambda f: F.array_contains("__clash", f["x"])), lambda f: f["p"]))
        free = F.filter("__ipos", lambda q: ~F.exists("__bad", lambda p: (p >= q) & (p < q + F.col("__w"))))
        filled = filled.withColumn("__ipos", F.when(F.size("__bad") > 0, free).otherwise(F.col("__ipos"))).where(F.size("__ipos") > 0)
        filled = filled.select(*kept, F.forall("__pairs", equal).alias("__same"))

        agreed = bare.unionByName(filled)
        # The longest run of windows in a row, counted in tokens.
        start = F.struct(F.lit(-1).alias("at"), F.lit(0).alias("run"), F.lit(0).alias("best"))
        longer = lambda s, q: F.when(q == s["at"] + 1, s["run"] + 1).otherwise(F.lit(1))
        runs = F.aggregate(F.array_sort("__ipos"), start, lambda s, q: F.struct(q.alias("at"), longer(s, q).alias("run"), F.greatest(s["best"], longer(s, q)).alias("best")), lambda s: s["best"])
        tokens = F.when(F.size("__ipos") + F.col("__w") > passage, runs + F.col("__w") - 1).otherwise(0)
        agreed = agreed.withColumn("__run", tokens)
        leaks = agreed.groupBy("__id", "__key", "__ikey", "__form", "__item", "__n").agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("__ipos")))).cast("long").alias("matched"), F.bool_and("__same").alias("__same"), F.max("__run").alias("__run")
        )
        # Of the two forms the one with more coverage, and at a tie the literal one.
        best = F.struct((F.col("matched") / F.col("__n")).alias("share"), (-F.col("__form")).alias("form"), "matched", "__n", "__same")
        leaks = leaks.groupBy("__id", "__key", "__ikey", "__item").agg(F.max(best).alias("__best"), F.max("__run").alias("__run")).select("__id", "__item", "__best.*", "__run")
        share = F.col("share")
        out = leaks.where((share >= coverage) | (F.col("__run") >= passage)).select(
            F.col("__id").alias(id_col), F.col("__item").alias(item_col), "matched", F.col("__n").cast("int").alias("windows"), share.cast("double").alias("coverage"), F.when(F.col("__same"), "verbatim").otherwise("re-parameterised").alias("kind")
        )
        return scratch.result(out)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, width: int = 8, coverage: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item leaks, with all their columns.

    Rows are judged by id and text, so null ids stay apart; null and empty texts stay.
    """
    (rid,) = fresh(docs.columns, "__rid")
    own = docs.withColumn(rid, row_key(id_col, text_col))
    leaks = find_leaks(own.select(rid, F.col(text_col)), benchmark, width, coverage, rid, text_col)
    gone = Scratch(docs.sparkSession, "leaks").result(leaks.select(rid).distinct(), "gone")
    return own.join(_within(gone), rid, "left_anti").select(*docs.columns)
