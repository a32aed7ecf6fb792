"""Line dedup by a segment-partition edit join, in DataFrame functions only.

Distinct lines are split into max_edits + 1 segments. Of two lines within max_edits edits one
segment of the shorter occurs whole in the longer, and only at few places, which follow from both
lengths. So segments are indexed by (length, segment number, text), and the longer line probes
the places that its length allows. Keys of a single line are dropped by counting. Pairs that meet
on the others, and whose counts of frequent characters differ by no more than the edits allow,
are verified by an edit distance whose band of the matrix is kept in the bits of two numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_hash, settle, unused

MAX_EDITS = 2
MIN_CHARS = 32
WIDTH = 4  # bytes of a character in UTF-32
FILTER_WORDS = 1 << 18
LAST = "decimal(38,0)"
COUNTED = " etaoinshrdlucmfwypvbgkjxqz.,"  # characters whose counts are compared


def _lines(docs: DataFrame, min_chars: int, copy_chars: int | None = None) -> DataFrame:
    """k0, k1 (the document), place (its order among all lines), line_no, line, h0, h1.

    Lines of fewer than ``min_chars`` characters are left out, but for those of at least
    ``copy_chars`` that are not blank.
    """
    wide = F.length("line") >= min_chars
    if copy_chars is not None:
        wide |= (F.length("line") >= copy_chars) & F.col("line").rlike(r"\S")
    order = (F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(str(1 << 63)).cast(LAST))
             * F.lit(1 << 31).cast("decimal(11,0)")).cast(LAST)
    rows = docs.select("k0", "k1", order.alias("base"), F.posexplode(
        F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), "\n", -1))
        .alias("line_no", "line"))
    line = F.trim("line")
    return (
        rows.select("k0", "k1", (F.col("base") + F.col("line_no")).cast(LAST).alias("place"),
                    "line_no", line.alias("line"))
        .filter(wide)
        .select("*", F.xxhash64(F.lit(3), "line").alias("h0"),
                F.xxhash64(F.lit(5), "line").alias("h1")))


def _keys(places: list[tuple[int, int, int]], max_edits: int) -> Column:
    """One key per place of a line, given by ``length`` and ``wide``, four bytes per character.

    A place is (how much shorter the other line is, number of its segment, shift of this line's
    substring from where the segment stands in the other). Of a length that does not divide
    evenly the last segments take one character more.
    """
    parts, keys = max_edits + 1, []
    for shorter, number, shift in places:
        other = F.col("length") - shorter
        size = F.expr(f"(length - {shorter}) div {parts}").cast("int")
        short = parts - other % parts  # so many segments have the smaller size
        start = number * size + F.greatest(F.lit(0), number - short) + shift
        size = size + (F.lit(number) >= short).cast("int")
        keys.append(F.xxhash64(other, F.lit(number),
                               F.substring("wide", start * WIDTH + 1, size * WIDTH)))
    return F.array(*keys)


def _segment_places(max_edits: int) -> list[tuple[int, int, int]]:
    return [(0, i, 0) for i in range(max_edits + 1)]


def _probe_places(max_edits: int) -> list[tuple[int, int, int]]:
    """Where a segment of a line at most as long can stand in this one.

    With i segments before, at most i edits lie before a match and the rest behind it, so its
    place may differ by no more than that, counted from either end.
    """
    return [(shorter, i, shift)
            for shorter in range(max_edits + 1) for i in range(max_edits + 1)
            for shift in range(max(-i, shorter - (max_edits - i)),
                               min(i, shorter + (max_edits - i)) + 1)]


def _counts() -> Column:
    """How often the line has each of the counted characters."""
    return F.array(*[
        F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit(c), F.lit("")))
        for c in COUNTED])


def _close_counts(a: str, b: str, max_edits: int) -> Column:
    """Whether the counts leave it possible: an edit changes two of them by one at most."""
    apart = F.zip_with(a, b, lambda x, y: F.abs(x - y))
    return F.aggregate(apart, F.lit(0), lambda total, n: total + n) <= 2 * max_edits


def edit_distance_within(a: Column, b: Column, max_edits: int) -> Column:
    """Whether the distance of a and b, a being at most as long, is within ``max_edits``.

    Bit t of the two numbers says whether the matrix rises or falls from row to row at row
    j - max_edits + t of column j. The distance is followed down the band's lower edge and then
    along the last row. Both texts must be longer than ``max_edits`` and lengths may differ by
    no more than that.
    """
    k = max_edits
    mask, top = (1 << (2 * k + 1)) - 1, 2 * k

    def let(value: Column, use) -> Column:
        return F.get(F.transform(F.array(value), use), 0)

    def bit(value: Column, t: Column | int) -> Column:
        t = F.lit(t) if isinstance(t, int) else t
        return F.call_function("shiftright", value, t.cast("int")).bitwiseAND(1).cast("int")

    def inverted(value: Column) -> Column:
        return F.bitwise_not(value).bitwiseAND(mask)

    def follow(low: Column) -> Column:
        def bits(char: Column, j: Column) -> Column:
            found = F.lit(0).cast("long")
            for t in range(2 * k + 1):
                same = F.coalesce(F.get(low, j + (t - k)) == char, F.lit(False))
                found = found + F.when(same, F.lit(1 << t)).otherwise(0).cast("long")
            return found

        def step(state: Column, column: Column) -> Column:
            up, down, x = state.up, state.down, column.x
            level = ((x.bitwiseAND(up) + up).bitwiseXOR(up)).bitwiseOR(x).bitwiseOR(down) \
                .bitwiseAND(mask)

            def with_level(d: Column) -> Column:
                right_up = down.bitwiseOR(inverted(d.bitwiseOR(up)))
                right_down = d.bitwiseAND(up)

                def with_row(h: Column) -> Column:
                    next_ = F.shiftright(d, 1)
                    row = F.size(low) - column.j - 1 + k  # the last row's bit in this column
                    change = F.when(row >= top, 1 - bit(d, top)).otherwise(
                        bit(h, row) - bit(right_down, row))
                    return F.struct(
                        right_down.bitwiseOR(inverted(next_.bitwiseOR(h))).alias("up"),
                        next_.bitwiseAND(h).alias("down"), (state.far + change).alias("far"))

                return let(right_up, with_row)

            return let(level, with_level)

        columns = F.transform(F.split(b, ""), lambda c, j: F.struct(
            bits(c, j).alias("x"), j.alias("j")))
        start = F.struct(F.lit(mask & ~((1 << k) - 1)).cast("long").alias("up"),
                         F.lit(0).cast("long").alias("down"), F.lit(k).alias("far"))
        return F.aggregate(columns, start, step, lambda s: s.far) <= k

    # The characters are bound once: they would else be split anew at every step.
    return let(F.split(a, ""), follow)


def _listed(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Add ``listed``: true where the hash in the column is among the wanted, and for a few others.

    FILTER_WORDS numbers of 64 bits are broadcast, whatever the number of wanted hashes.
    """
    word = F.pmod(F.col(column), F.lit(FILTER_WORDS))
    bit = F.pmod(F.shiftright(column, 32), F.lit(64)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    flags = settle(wanted.groupBy(word.alias("word")).agg(F.bit_or(one).alias("flags")))
    return (
        df.withColumn("word", word).join(F.broadcast(flags), "word", "left")
        .withColumn("listed", F.coalesce(F.col("flags").bitwiseAND(one) != 0, F.lit(False)))
        .drop("word", "flags"))


def _shared_keys(coded: DataFrame, max_edits: int) -> DataFrame:
    """h0, key and whether it is of a segment of the line itself, for keys that occur repeatedly.

    The places of a line's own segments are among its probes, so these are all that is computed
    and counted. A key that one line alone has twice passes too and meets no other line's.
    """
    shared = settle(
        coded.select(F.explode("probe").alias("key")).groupBy("key")
        .agg(F.count("*").alias("n")).filter("n > 1").select("key"))
    places = _probe_places(max_edits)
    own = [places.index(p) for p in _segment_places(max_edits)]
    every = coded.select("h0", F.posexplode("probe").alias("place", "key"))
    return settle(_listed(every, "key", shared).filter("listed").select(
        "h0", "key", F.col("place").isin(own).alias("own")))


def line_links(docs: DataFrame, lines: DataFrame, firsts: DataFrame,
               max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Pairs of different lines within ``max_edits`` edits: h0, h1, and g0, g1, of both.

    ``lines`` tells which document has which line, ``firsts`` each line's number of copies. Lines
    that surely have no copy are taken as they stand; the others are made distinct.
    """
    marked = _listed(_lines(docs, min_chars).select("h0", "line"), "h0",
                     firsts.filter("copies > 1").select("h0"))
    several = marked.filter("listed").groupBy("line").agg(F.min("h0").alias("h0"))
    distinct = marked.filter("not listed").select("h0", "line").unionByName(several)
    coded = settle(
        distinct.select("h0", F.length("line").alias("length"),
                        F.encode("line", "UTF-32").alias("wide"))
        .select("h0", _keys(_probe_places(max_edits), max_edits).alias("probe")))
    shared = _shared_keys(coded, max_edits)
    # Texts are fetched for these lines only, from the documents that have them.
    wanted = settle(shared.select("h0").distinct())
    homes = lines.join(wanted, "h0", "left_semi").select("k0")
    some = _listed(docs, "k0", homes).filter("listed").drop("listed")
    texts = settle(
        _listed(_lines(some, min_chars), "h0", wanted).filter("listed").groupBy("line")
        .agg(F.min("h0").alias("h0"), F.min("h1").alias("h1"))
        .withColumn("counts", _counts()))
    keyed = settle(shared.join(texts.select("h0", "counts"), "h0"))
    index = keyed.filter("own").select(
        "key", F.col("h0").alias("x"), F.col("counts").alias("counts_x"))
    probe = keyed.select(
        "key", F.col("h0").alias("y"), F.col("counts").alias("counts_y"))
    met = settle(
        index.join(probe, "key")
        .filter((F.col("x") != F.col("y")) & _close_counts("counts_x", "counts_y", max_edits))
        .select("x", "y").distinct())
    pairs = (
        met.join(texts.select(F.col("h0").alias("x"), F.col("h1"), F.col("line").alias("a")), "x")
        .join(texts.select(F.col("h0").alias("y"), F.col("h1").alias("g1"),
                           F.col("line").alias("b")), "y")
        .withColumn("gap", F.length("b") - F.length("a"))
        # Lines of equal length meet twice, either way.
        .filter(((F.col("gap") > 0) | ((F.col("gap") == 0) & (F.col("a") < F.col("b"))))
                & (F.col("gap") <= max_edits)))
    return settle(
        pairs.filter(edit_distance_within(F.col("a"), F.col("b"), max_edits))
        .select(F.col("x").alias("h0"), "h1", F.col("y").alias("g0"), "g1").distinct())


def line_classes(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS,
                 copy_chars: int | None = None) -> DataFrame:
    """Per line that has a copy or a near line: k0, k1, line_no, first, near, n_links.

    ``first`` says whether it is the first of all equal lines, ``near`` whether a different line
    within ``max_edits`` edits comes before all its equals; n_links counts such lines, before or
    after. Only lines of at least ``min_chars`` characters are compared by edits. All other lines
    that ``_lines`` lists are first, not near and without links.
    """
    lines = settle(_lines(docs, min_chars, copy_chars).select("k0", "k1", "place", "line_no", "h0", "h1"))
    firsts = settle(lines.groupBy("h0", "h1").agg(
        F.min("place").alias("begin"), F.count("*").alias("copies")))
    links = line_links(docs, lines, firsts, max_edits, min_chars)
    both = links.unionByName(links.select(
        F.col("g0").alias("h0"), F.col("g1").alias("h1"), F.col("h0").alias("g0"),
        F.col("h1").alias("g1")))
    other = firsts.select(F.col("h0").alias("g0"), F.col("h1").alias("g1"),
                          F.col("begin").alias("other"))
    earlier = (F.col("other") < F.col("begin")) | (
        (F.col("other") == F.col("begin")) & (F.col("g0") < F.col("h0")))
    linked = (
        both.join(firsts, ["h0", "h1"]).join(other, ["g0", "g1"])
        .groupBy("h0", "h1").agg(F.count("*").alias("n_links"), F.bool_or(earlier).alias("near")))
    known = settle(firsts.join(linked, ["h0", "h1"], "left")
                   .filter("copies > 1 or n_links is not null").drop("copies"))
    return lines.join(known, ["h0", "h1"]).select(
        "k0", "k1", "line_no", (F.col("place") == F.col("begin")).alias("first"),
        F.coalesce("near", F.lit(False)).alias("near"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return given.select("*", *[h.alias(f"k{i}") for i, h in enumerate(
        doc_hash(F.col("doc_id"), F.col("text")))])


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS,
                copy_chars: int | None = None) -> DataFrame:
    """Per row: doc_id, n_lines, n_copies, n_near, n_links, dropped (line numbers from 0).

    Lines are what line breaks separate, compared in lower case and without blanks at the ends.
    Lines come in the order of (id, line number), null ids last. A line of at least ``min_chars``
    characters is dropped as a copy if an equal one comes before it, else as near if a different
    one within ``max_edits`` edits comes before. Shorter lines stay, but for copies of non-blank
    ones of at least ``copy_chars`` characters, if given. n_links counts, over a row's lines, the
    different lines within ``max_edits`` edits. Rows equal in id and text are
    one document and lose the same lines; of rows that share an id only, equal lines at the same
    number both stay. Null and empty texts have one empty line. Ids are whole numbers. Other
    columns are not read; an empty table gives no rows.
    """
    keyed = _keyed(docs, id_col, text_col)
    # Rows equal in id and text give each line several times, with the same answer.
    per_line = line_classes(keyed, max_edits, min_chars, copy_chars).distinct()
    gone = ~F.col("first") | F.col("near")
    found = per_line.groupBy("k0", "k1").agg(
        F.count_if(~F.col("first")).alias("n_copies"),
        F.count_if(F.col("first") & F.col("near")).alias("n_near"),
        F.sum("n_links").alias("n_links"),
        F.sort_array(F.collect_list(F.when(gone, F.col("line_no")))).alias("dropped"))
    n_lines = F.size(F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1))
    zero = F.lit(0).cast("long")
    return keyed.select("doc_id", "k0", "k1", n_lines.alias("n_lines")).join(
        found, ["k0", "k1"], "left").select(
        "doc_id", "n_lines", *[F.coalesce(c, zero).alias(c)
                               for c in ("n_copies", "n_near", "n_links")],
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS,
               copy_chars: int | None = None) -> DataFrame:
    """The table with the lines dropped that line_report names; all rows and columns stay.

    A text of which nothing is dropped stays as it is, null included.
    """
    k0, k1, drop, text = unused(docs, "k0_", "k1_", "dropped_", "kept_")
    keys = doc_hash(F.col(id_col), F.col(text_col))
    gone = (
        line_classes(_keyed(docs, id_col, text_col), max_edits, min_chars, copy_chars)
        .filter(~F.col("first") | F.col("near"))
        .groupBy(F.col("k0").alias(k0), F.col("k1").alias(k1))
        .agg(F.collect_set("line_no").alias(drop)))
    kept = F.array_join(F.filter(
        F.split(F.col(text_col), "\n", -1),
        lambda _, i: ~F.array_contains(F.col(drop), i)), "\n")
    columns = [F.col(text).alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return (
        docs.withColumns({k0: keys[0], k1: keys[1]}).join(settle(gone), [k0, k1], "left")
        .withColumn(text, F.when(F.col(drop).isNull(), F.col(text_col)).otherwise(kept))
        .select(*columns))
