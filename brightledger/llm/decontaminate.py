"""Benchmark decontamination by templates, in DataFrame functions only.

Texts and benchmark items are cut into words, numbers and sentence breaks. Numbers, units
after a number and names (capitalised words inside a sentence) become typed placeholders, the
rest is lower case. Windows of the template are joined by hash; where enough words of an
item lie in a text in a row, the values in the slots are compared: a value of the item must
stand for one value of the text throughout, and unless asked otherwise the reverse as well. So a
question with other numbers or names is found, and texts that only share its form are not. Windows of the plain words in lower case
are joined as well, so copies in other case or broken into other lines are found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brightledger.llm.common import let, stored

WINDOW = 8
# Words of a run that are no placeholder, at least.
LITERALS = 5
# Words in a row that make a match; an item of fewer must be there as a whole.
RUN = 10
# Words in a row with the same values that make a match whatever the slots around them hold.
VERBATIM = 13
# Words of an item that is looked for, at least; those of fewer than a window must be there as
# a whole with their values.
SHORT = 4
# Windows of the benchmark that are broadcast at most (about 50 MB); more are joined by shuffle.
BROADCAST_WINDOWS = 1_000_000

# Scripts without blanks between words (Thai, Lao, Burmese, Khmer, kana, Han): a letter is a word.
_NO_BLANKS = (
    r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3005-\u3006\u3031-\u3035\u3040-\u30FF\u31F0-\u31FF"
    r"\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uFF66-\uFF9F\x{1B000}-\x{1B16F}\x{20000}-\x{3FFFF}"
)
_LETTERS = rf"[a-zA-Z[\p{{L}}&&[^{_NO_BLANKS}]]][a-zA-Z[\p{{L}}\p{{M}}&&[^{_NO_BLANKS}]]]*|[\p{{L}}&&[{_NO_BLANKS}]]\p{{M}}*"
_TOKEN = rf"{_LETTERS}|[0-9]+(?:[.,][0-9]+)*|[.!?\n]"
BREAKS = (".", "!", "?", "\n")
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles",
    "meter", "meters", "metre", "metres", "mg", "g", "kg", "gram", "grams", "kilogram", "kilograms",
    "ounce", "ounces", "pound", "pounds", "ton", "tons", "ml", "l", "liter", "liters", "litre", "litres",
    "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks",
    "month", "months", "year", "years", "cent", "cents", "dollar", "dollars", "euro", "euros",
    "percent", "degree", "degrees", "mph", "kmh",
)
NUMBER, UNIT, NAME, BREAK = "<number>", "<unit>", "<name>", "<break>"


def _is_number(token: Column) -> Column:
    return (token >= "0") & (token < ":")


def _kind(token: Column, before: Column) -> Column:
    low = F.lower(token)
    tail = F.substring(token, 2, 1 << 30)
    return (
        F.when(token.isin(*BREAKS), BREAK)
        .when(_is_number(token), NUMBER)
        .when(_is_number(before) & low.isin(*UNITS), UNIT)
        .when((token == low) | before.isin(*BREAKS), low)
        .when((F.length(token) > 1) & (tail == F.lower(tail)), NAME)
        .otherwise(low)
    )


def _tokens(text: Column, of_token) -> Column:
    """``of_token(token, the one before it)`` for each token of the text, breaks included; a
    text begins like a sentence."""
    cut = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    shifted = lambda t: F.concat(F.array(F.lit(".")), F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0))))
    return let(cut, lambda t: F.zip_with(t, shifted(t), of_token))


def _is_capitalised(token: Column) -> Column:
    low, tail = F.lower(token), F.substring(token, 2, 1 << 30)
    return (token != low) & (F.length(token) > 1) & (tail == F.lower(tail))


def slots(text: Column, capitals: bool = False) -> Column:
    """The kind and the value of each word of the template, without breaks; with ``capitals``
    also whether it is capitalised, as a name that begins a sentence is."""

    def slot(t: Column, b: Column) -> Column:
        more = [_is_capitalised(t).alias("capital")] if capitals else []
        return F.struct(_kind(t, b).alias("kind"), F.lower(t).alias("value"), *more)

    return F.filter(_tokens(text, slot), lambda s: s["kind"] != BREAK)


def windows(words: Column) -> Column:
    """A hash of each window of the words of a template, in order. Pairs, fours and eights are
    hashed in turn, so a word is handled three times, not eight."""

    def doubled(hashes: Column, step: int) -> Column:
        def paired(h: Column) -> Column:
            shifted = F.slice(h, step + 1, F.greatest(F.size(h) - step, F.lit(0)))
            return F.zip_with(F.slice(h, 1, F.greatest(F.size(h) - step, F.lit(0))), shifted, lambda a, b: F.xxhash64(a, b))

        return let(hashes, paired)

    hashes = F.transform(words, lambda k: F.xxhash64(k))
    return doubled(doubled(doubled(hashes, 1), 2), 4)


def whole(words: Column, length: int) -> Column:
    """A hash of each run of ``length`` words, for items that have no window."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def longer(h: Column, one: Column, n: int) -> Column:
        if n == length:
            return h
        size = F.greatest(F.size(h) - 1, F.lit(0))
        grown = F.zip_with(F.slice(h, 1, size), F.slice(one, n + 1, size), lambda a, b: F.xxhash64(a, b))
        return let(grown, lambda g: longer(g, one, n + 1))

    return let(hashes, lambda one: longer(one, one, 1))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, slots, size) of each text of an item: ``item`` is a hash of both columns."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct()
    made = items.select(F.xxhash64("item_id", "text").alias("item"), "item_id", slots(F.col("text"), capitals=True).alias("slots"))
    return made.select("*", F.size("slots").alias("size")).where(F.col("size") >= SHORT)


def benchmark_windows(items: DataFrame) -> DataFrame:
    """(window, item, at, rank, plain): the windows of plain words and those of the template that
    hold a literal word, counted by ``rank``. A run with literal words enough has such a window,
    so those of placeholders alone, which every table of numbers is full of, need not be joined.
    An item of fewer words is one window of its own length."""
    made = windows(F.transform("slots", lambda s: s["kind"]))
    literal = lambda w, at: F.when(_literals(at, at + WINDOW) > 0, F.struct(w.alias("window"), at.alias("at")))
    seeds = items.select("item", F.posexplode(F.array_compact(F.transform(made, literal))).alias("rank", "seed"))
    plain = items.select("item", F.posexplode(windows(F.transform("slots", lambda s: s["value"]))).alias("at", "window"))
    made = seeds.select("seed.window", "item", "seed.at", "rank", F.lit(False).alias("plain"))
    made = made.union(plain.select("window", "item", "at", F.col("at").alias("rank"), F.lit(True).alias("plain")))
    words = F.transform("slots", lambda s: s["value"])
    for length in range(SHORT, WINDOW):
        window = F.get(whole(words, length), F.lit(0)).alias("window")
        few = items.where(F.col("size") == length)
        made = made.union(few.select(window, "item", F.lit(0).alias("at"), F.lit(0).alias("rank"), F.lit(True).alias("plain")))
    return made


def document_windows(text: Column, lengths: list[int]) -> Column:
    """The windows of a text's template, those of its plain words, null where they are equal, and
    its runs of as many plain words as ``lengths`` says."""

    def both(words: Column) -> Column:
        typed, plain = (windows(F.transform(words, lambda w: w[name])) for name in ("kind", "value"))
        some = F.exists(words, lambda w: w["kind"].startswith("<"))
        other = lambda t: F.when(some, F.zip_with(t, plain, lambda a, b: F.when(a != b, b)))
        short = [whole(F.transform(words, lambda w: w["value"]), length) for length in lengths]
        return let(typed, lambda t: F.array(t, other(t), *short))

    return let(slots(text), both)


def _literals(begin: Column, end: Column) -> Column:
    """The number of literal words of an item from place ``begin`` to before ``end``."""
    return F.size(F.filter(F.slice("slots", begin + 1, end - begin), lambda s: ~s["kind"].startswith("<")))


def matches(documents: DataFrame, benchmark: DataFrame, one_to_one: bool = True) -> DataFrame:
    """(doc_id, row, item_ids) of the texts of ``documents`` (doc_id, text) that hold items of
    ``benchmark`` (item_id, text): ``row`` is a hash of both columns, the items ascend.

    A document holds an item if at least ``RUN`` words of the item's template (or all of a
    shorter item) lie in its template in a row, at least ``LITERALS`` of them no placeholders,
    and the values in the slots of the run, as far as the templates agree, map one to one.
    Placeholders at an end of the run that is no end of the item may agree by chance: the run
    may do without them.

    Without ``one_to_one`` an item's value must stand for one value of the text, but several may
    stand for the same (small numbers often coincide); a slot with a second value ends the run and
    begins another instead of undoing it, so each part is long enough on its own or not; and a
    capitalised word may take the place of another one, so names that begin a sentence are slots too.

    ``VERBATIM`` words in a row (or all of a shorter item) with the values
    of the item are a match whatever the other slots hold, in any case and broken into any lines.
    Items of fewer than ``WINDOW`` words are found where all of them lie in a row with the same
    values, those of fewer than ``SHORT`` are too unspecific and never found. A letter of a script
    without blanks between words is a word. Null and empty
    texts hold nothing; rows of the benchmark without id or text are ignored; an item_id with
    several texts is found if one of them is; a null doc_id is an id like any other and repeated rows
    have one result; texts are read whole, of any length. Other columns are ignored; an empty table of
    documents gives no rows, an empty benchmark finds nothing.

    Words are exploded only as hashes of windows. The benchmark's windows are broadcast if a
    count says they are few, and joined by shuffle otherwise; matches are reduced per document
    and item in the task that finds them. Values are compared only in the documents that match
    by template alone.
    """
    items = stored(benchmark_items(benchmark), "benchmark-items")
    looked_for = stored(benchmark_windows(items), "benchmark-windows")
    if looked_for.count() <= BROADCAST_WINDOWS:
        looked_for = F.broadcast(looked_for)
    keyed = documents.select("doc_id", _row().alias("row"), "text")
    lengths = sorted(r["size"] for r in items.where(F.col("size") < WINDOW).select("size").distinct().collect())
    made = F.explode(document_windows(F.col("text"), lengths)).alias("windows")
    exploded = keyed.where("text IS NOT NULL").select("doc_id", "row", made)
    exploded = exploded.select("doc_id", "row", F.posexplode("windows").alias("place", "window"))
    runs = (
        exploded.join(looked_for, "window")
        .groupBy("doc_id", "row", "item", (F.col("place") - F.col("at")).alias("shift"))
        .agg(F.array_sort(F.collect_set(F.struct("plain", "rank", "at"))).alias("hits"))
    )
    # Windows in a row have one difference of their rank to their place in the list: cut the
    # hits into runs.
    cut = runs.select("doc_id", "row", "item", "shift", F.posexplode("hits").alias("n", "hit"))
    cut = (
        cut.groupBy("doc_id", "row", "item", "shift", "hit.plain", (F.col("hit.rank") - F.col("n")).alias("run"))
        .agg(F.min("hit.at").alias("first"), F.max("hit.at").alias("last"))
        .join(items, "item")
        .withColumn("end", F.col("last") + F.least(F.lit(WINDOW), F.col("size")))
    )
    # Where a window of placeholders alone is next to the run, it may go on.
    bare = lambda at: _literals(at, at + WINDOW) == 0
    long = F.col("end") - F.col("first") >= F.least(F.lit(RUN), F.col("size"))
    long = long | ((F.col("end") < F.col("size")) & bare(F.col("end") - (WINDOW - 1)))
    long = long | ((F.col("first") > 0) & bare(F.greatest(F.col("first") - 1, F.lit(0))))
    if not one_to_one:
        # A name that begins a sentence is a literal of the template: the run may go on behind it.
        capital = lambda at: F.coalesce(F.get("slots", at.cast("int"))["capital"], F.lit(False))
        long = long | capital(F.col("end")) | ((F.col("first") > 0) & capital(F.col("first") - 1))
    likely = long & (_literals(F.col("first"), F.col("end")) >= LITERALS)
    copied = F.col("end") - F.col("first") >= F.least(F.lit(VERBATIM), F.col("size"))
    found = cut.where((F.col("plain") & copied) | (~F.col("plain") & likely))
    found = stored(found.groupBy("doc_id", "row", "item", "item_id", "shift").agg(F.max("plain").alias("plain")), "matches")

    same_row = [F.col("d.row") == F.col("m.row"), F.col("d.doc_id").eqNullSafe(F.col("m.doc_id"))]
    held = found.where("NOT plain").alias("m").join(keyed.alias("d"), same_row).select("m.*", "d.text")
    held = held.dropDuplicates(["doc_id", "row", "item", "shift"])

    def pair(d: Column, i: Column) -> Column:
        named = (d["kind"] != i["kind"]) & d["capital"] & i["capital"] & F.lit(not one_to_one)
        kind = lambda s: F.when(named, NAME).otherwise(s["kind"])
        return F.struct(kind(d).alias("kind"), kind(i).alias("item_kind"), d["value"].alias("value"), i["value"].alias("item_value"))

    # The whole item laid over the text at its shift.
    begin = F.greatest("shift", F.lit(0))
    held = held.withColumn("begin", begin).withColumn("in_text", slots(F.col("text"), capitals=True)).drop("text")
    held = held.join(items.select("item", "slots", "size"), "item")
    size = F.least(F.col("size") + F.col("shift"), F.size("in_text")) - F.col("begin")
    laid = F.zip_with(F.slice("in_text", F.col("begin") + 1, size), F.slice("slots", F.col("begin") - F.col("shift") + 1, size), pair)
    pairs = held.select("doc_id", "row", "item_id", "size", (F.col("begin") - F.col("shift")).alias("offset"), laid.alias("pairs"))

    def is_one_to_one(run: Column) -> Column:
        both = F.filter(run, lambda p: p["kind"].startswith("<"))
        values = lambda f, name: F.size(F.array_distinct(F.transform(f, lambda p: F.struct(p["kind"], p[name]))))
        return let(F.array_distinct(both), lambda f: (values(f, "value") == F.size(f)) & (values(f, "item_value") == F.size(f)))

    def enough(run: Column) -> Column:
        words = F.size(F.filter(run, lambda p: ~p["kind"].startswith("<")))
        return (F.size(run) >= F.least(F.lit(RUN), F.col("size"))) & (words >= LITERALS)

    def core(run: Column, at: Column) -> Column:
        """The run, from place ``at`` of the item, without the placeholders at its ends inside the item."""
        literal = F.array_compact(F.transform(run, lambda p, n: F.when(~p["kind"].startswith("<"), n)))
        low = F.when(at == 0, 0).otherwise(F.coalesce(F.array_min(literal), F.lit(0)))
        high = F.when(at + F.size(run) == F.col("size"), F.size(run)).otherwise(F.coalesce(F.array_max(literal) + 1, F.lit(0)))
        return F.slice(run, low + 1, F.greatest(high - low, F.lit(0)))

    def between(places: Column, size: Column, use) -> Column:
        """Whether ``use(first, words)`` holds for a stretch between two of the places."""
        cuts = F.concat(F.array(F.lit(-1)), F.array_compact(places), F.array(size))
        words = lambda low, high: F.greatest(high - low - 1, F.lit(0))
        each = lambda c: F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda a, b: use(a + 1, words(a, b)))
        return F.exists(let(cuts, each), lambda held: held)

    def holds(pairs: Column) -> Column:
        """Whether one of the runs in which the templates agree is long enough and consistent."""
        other = F.transform(pairs, lambda p, n: F.when(p["kind"] != p["item_kind"], n))

        def consistent(run: Column, at: Column) -> Column:
            whole = enough(run) & is_one_to_one(run)
            return whole | let(core(run, at), lambda r: enough(r) & is_one_to_one(r))

        def consistent_part(run: Column) -> Column:
            """Whether a stretch in which an item's value stands for one value is long enough."""
            numbered = F.transform(run, lambda p, n: F.struct(n.alias("n"), *[p[f].alias(f) for f in ("kind", "item_value", "value")]))
            in_slots = F.filter(numbered, lambda s: s["kind"].startswith("<"))

            def earlier(found: Column, s: Column) -> Column:
                """The last place before ``s`` at which its item's value stands for another one."""
                same = lambda t: (t["n"] < s["n"]) & (t["kind"] == s["kind"]) & (t["item_value"] == s["item_value"])
                return F.array_max(F.transform(F.filter(found, lambda t: same(t) & (t["value"] != s["value"])), lambda t: t["n"]))

            def parts(found: Column) -> Column:
                clashes = F.transform(found, lambda s: F.struct(s["n"].alias("n"), earlier(found, s).alias("p")))
                return let(F.filter(clashes, lambda c: c["p"].isNotNull()), some_part)

            def some_part(clashes: Column) -> Column:
                def part(end: Column) -> Column:
                    begin = F.array_max(F.transform(F.filter(clashes, lambda c: c["n"] < end), lambda c: c["p"] + 1))
                    return let(F.coalesce(begin, F.lit(0)), lambda b: F.slice(run, b + 1, F.greatest(end - b, F.lit(0))))

                ends = F.concat(F.transform(clashes, lambda c: c["n"]), F.array(F.size(run)))
                return F.exists(ends, lambda end: let(part(end), enough))

            values = lambda f, *names: F.size(F.array_distinct(F.transform(f, lambda s: F.struct(s["kind"], *[s[n] for n in names]))))
            clear = lambda f: values(f, "item_value") == values(f, "item_value", "value")
            return enough(run) & let(in_slots, lambda f: F.when(clear(f), True).otherwise(parts(f)))

        held_by = lambda r, at: consistent(r, at) if one_to_one else consistent_part(r)
        run_holds = lambda first, n: let(F.slice(pairs, first + 1, n), lambda r: held_by(r, F.col("offset") + first))
        return between(other, F.size(pairs), run_holds)

    flagged = pairs.where(let(F.col("pairs"), holds)).select("doc_id", "row", "item_id")
    flagged = flagged.union(found.where("plain").select("doc_id", "row", "item_id"))
    flagged = flagged.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))

    return stored(flagged, "contaminated")


def _row() -> Column:
    return F.xxhash64("doc_id", "text")


def contaminated(documents: DataFrame, benchmark: DataFrame, one_to_one: bool = True) -> DataFrame:
    """One row per row of ``documents``: doc_id, ``contaminated`` and ``item_ids`` as in
    ``matches``, empty for the others."""
    left = documents.select("doc_id", _row().alias("row")).alias("d")
    right = matches(documents, benchmark, one_to_one).alias("m")
    same_row = [F.col("d.row") == F.col("m.row"), F.col("d.doc_id").eqNullSafe(F.col("m.doc_id"))]
    return left.join(right, same_row, "left").select(
        F.col("d.doc_id").alias("doc_id"),
        F.col("m.item_ids").isNotNull().alias("contaminated"),
        F.coalesce("m.item_ids", F.array().cast("array<long>")).alias("item_ids"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, one_to_one: bool = True) -> DataFrame:
    """The rows of ``documents``, all columns, that hold no benchmark item."""
    found = matches(documents, benchmark, one_to_one).alias("m")
    same_row = [F.xxhash64("d.doc_id", "d.text") == F.col("m.row"), F.col("d.doc_id").eqNullSafe(F.col("m.doc_id"))]
    return documents.alias("d").join(found, same_row, "left_anti")
