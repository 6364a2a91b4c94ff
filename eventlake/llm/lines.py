"""Lines that repeat, exactly or within a few edits, across a corpus.

Built-in functions only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import Places, free_name, settle, with_units


#: Times that equal halves are taken off two lines before their characters are compared.
HALVINGS = 3
#: Characters that make no word.
SPACES = " \t\x0b\x0c\r"


def without_repeated_lines(
    docs: DataFrame,
    max_edits: int = 2,
    least_chars: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    short_repeats: bool = False,
) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text_col``, and the columns
    n_lines, n_removed and n_links added.

    Lines are the \\n-separated parts of a text; those of fewer than ``least_chars``
    characters have no links, and stay. With ``short_repeats`` they too go, if they have
    a word and an equal line stands earlier. Of the others a line goes if an equal line,
    or another within ``max_edits`` insertions, deletions or substitutions, stands
    earlier: in a document of smaller id, or further up. n_links counts, over the lines of
    a document, the different texts within ``max_edits`` of the line's. A null text stays
    null and has no lines; an empty text is one line without a word. Rows that repeat id
    and text are one document, and lose the same lines. Columns of ``docs`` that are named
    n_lines, n_removed or n_links give way to these.
    """
    unit = free_name(docs, "unit")
    numbered = with_units(docs, unit, id_col, text_col)
    texts = numbered.select(F.col(unit).alias("unit"), F.col(text_col).alias("text"))
    places = Places.of(texts, "unit")
    lines = _lines(texts, places, least_chars, short_repeats)
    distinct = settle(
        lines.groupBy("line", "chars").agg(
            F.min("place").alias("first"), F.count(F.lit(1)).alias("n")
        ),
        "lines",
    )
    long_ones = distinct.filter(F.col("chars") >= least_chars)
    links = settle(linked_lines(long_ones, max_edits, least_chars), "line-links")
    verdicts = _verdicts(distinct, links)
    hashed = lines.select("unit", "at", "place", *_hashes())
    found = hashed.join(verdicts, ["h1", "h2"]).distinct()
    repeated = (F.col("place") != F.col("first")) | F.col("near")
    per_unit = settle(
        found.groupBy("unit").agg(
            F.collect_list(F.when(repeated, F.col("at"))).alias("removed"),
            F.sum("links").alias("n_links"),
        ),
        "removed-lines",
    )
    removed, n_links, key = (free_name(docs, n) for n in ("removed", "links", "unit_of_lines"))
    per_unit = per_unit.select(
        F.col("unit").alias(key), F.col("removed").alias(removed), F.col("n_links").alias(n_links)
    )
    joined = numbered.join(per_unit.hint("merge"), F.col(unit) == F.col(key), "left")
    gone = F.coalesce(F.col(removed), F.array().cast("array<int>"))
    breaks = F.octet_length(text_col) - F.octet_length(F.replace(text_col, F.lit("\n"), F.lit("")))
    # Bound as an element, a text is split once and not for every line that is left.
    left = F.transform(F.array(F.split(text_col, "\n")), lambda parts: _without(parts, gone))[0]
    return joined.withColumns(
        {
            "n_lines": F.coalesce(breaks + 1, F.lit(0)).cast("long"),
            "n_removed": F.size(gone).cast("long"),
            "n_links": F.coalesce(F.col(n_links), F.lit(0)).cast("long"),
            text_col: F.when(F.size(gone) > 0, left).otherwise(F.col(text_col)),
        }
    ).drop(unit, key, *{removed, n_links} - {"n_links"})


def _without(parts: Column, gone: Column) -> Column:
    every = F.sequence(F.lit(0), F.size(parts) - 1)
    left = F.transform(F.array_except(every, gone), lambda i: F.get(parts, i))
    return F.array_join(left, "\n")


def _lines(
    texts: DataFrame, places: Places, least_chars: int, short_repeats: bool
) -> DataFrame:
    """(unit, at, place, line, chars) of the lines that may go."""
    parts = texts.select("unit", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    may_go = F.col("chars") >= least_chars
    if short_repeats:
        may_go |= F.length(F.translate("line", SPACES, "")) > 0
    return parts.withColumn("chars", F.length("line")).filter(may_go).select(
        "unit", "at", places.at(F.col("unit"), F.col("at")).alias("place"), "line", "chars"
    )


def _hashes() -> list[Column]:
    """128 bits that stand for a line where its text need not travel."""
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")]


def _verdicts(distinct: DataFrame, links: DataFrame) -> DataFrame:
    """(h1, h2, first, near, links) of the lines that occur again or are linked; near if
    a linked line stands earlier."""
    ends = links.select(F.col("later").alias("place"), F.lit(True).alias("is_later")).unionByName(
        links.select(F.col("earlier").alias("place"), F.lit(False).alias("is_later"))
    )
    linked = ends.groupBy("place").agg(
        F.max("is_later").alias("near"), F.count(F.lit(1)).alias("links")
    )
    keyed = distinct.select("first", "n", *_hashes())
    judged = keyed.join(linked, F.col("first") == F.col("place"), "left")
    return judged.filter("n > 1 OR links > 0").select(
        "h1",
        "h2",
        "first",
        F.coalesce("near", F.lit(False)).alias("near"),
        F.coalesce("links", F.lit(0)).alias("links"),
    )


def linked_lines(distinct: DataFrame, max_edits: int, least_chars: int) -> DataFrame:
    """(earlier, later): places of two different lines within ``max_edits`` edits.

    ``distinct`` holds each line once: (line, chars, first). A line is cut into one segment more
    than the edits allowed, so a line within reach has one of them unchanged. Each line is
    indexed by its segments, and probes the segments of lines as long or up to
    ``max_edits`` shorter with its own substrings, at the few places where a shared
    segment can be. Only hashes are shuffled for that. Keys that meet a different line
    bring their lines in; pairs that share a key are then compared inside the join, so
    that no more rows leave it than there are links.
    """
    probes = _probes(distinct, max_edits, least_chars).repartition("key")
    shared = (
        probes.groupBy("key")
        .agg(F.min("first").alias("a"), F.max("first").alias("b"), F.max("indexed").alias("i"))
        .filter("a <> b AND i")
        .select("key")
    )
    met = settle(probes.join(shared, "key"), "shared-segments")
    involved = met.select("first").distinct()
    # Which lines are involved grows with the corpus: that side is never broadcast.
    texts = distinct.join(involved.hint("merge"), "first", "left_semi").select(
        "first", "line", "chars", _parity("line").alias("parity")
    )
    keyed = settle(met.join(texts, "first"), "candidates")
    short = keyed.filter("indexed").select(
        F.col("key").alias("key_a"),
        F.col("first").alias("a"),
        F.col("line").alias("line_a"),
        F.col("chars").alias("chars_a"),
        F.col("parity").alias("parity_a"),
    )
    one_order = (F.col("chars_a") < F.col("chars")) | (F.col("a") < F.col("first"))
    alike = F.bit_count(F.col("parity_a").bitwiseXOR(F.col("parity"))) <= 2 * max_edits
    near = edits_within(F.col("line_a"), F.col("line"), max_edits)
    pairs = keyed.join(
        short,
        (F.col("key") == F.col("key_a"))
        & (F.col("a") != F.col("first"))
        & F.col("chars_a").between(F.col("chars") - max_edits, F.col("chars"))
        & one_order
        & alike
        & near,
    )
    return pairs.select(
        F.least("a", "first").alias("earlier"), F.greatest("a", "first").alias("later")
    ).distinct()


def _probes(distinct: DataFrame, max_edits: int, least_chars: int) -> DataFrame:
    """(first, key, indexed): a row for every substring of a line that may be a segment of
    a line of some characters less; its own segments are those it is indexed by.

    With d edits allowed, segment s (from 0) of the shorter line lies at most s places away
    in the longer one, and at most d - s places away when counted from the end. The moves
    this leaves are rows of a small constant list: a line goes through them in compiled
    code, with one copy of the expressions below for all of them.
    """
    segments = max_edits + 1
    moves = []
    for shorter in range(max_edits + 1):
        for s in range(segments):
            low = max(-s, shorter - (max_edits - s))
            high = min(s, shorter + (max_edits - s))
            for move in range(low, high + 1):
                moves.append((shorter, s, move))
    names = ("shorter", "s", "move")
    listed = F.array(
        *(F.struct(*(F.lit(x).alias(n) for x, n in zip(m, names))) for m in moves)
    )
    moved = distinct.select("first", "line", "chars", F.inline(listed).alias(*names))
    length, s = F.col("chars") - F.col("shorter"), F.col("s")
    base = F.call_function("div", length, F.lit(segments)).cast("int")
    longer_from = segments - length % segments
    begin = base * s + F.greatest(s - longer_from, F.lit(0))
    size = base + F.when(s >= longer_from, 1).otherwise(0)
    start = begin + F.col("move")
    fits = (length >= least_chars) & (start >= 0) & (start + size <= F.col("chars"))
    return moved.filter(fits).select(
        "first",
        F.xxhash64(length, s, F.substr("line", start + 1, size)).alias("key"),
        ((F.col("shorter") == 0) & (F.col("move") == 0)).alias("indexed"),
    )


def _parity(column: str) -> Column:
    """64 bits: the parity of the counts of characters, by their hash. An edit changes
    two of them at most."""
    return F.aggregate(
        F.split(column, ""),
        F.lit(0).cast("long"),
        lambda bits, c: bits.bitwiseXOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(c), F.lit(64)).cast("int"))
        ),
    )


def edits_within(one: Column, other: Column, max_edits: int) -> Column:
    """Whether two texts, ``one`` no longer than ``other``, are within ``max_edits`` edits.

    Bit-parallel along the band of diagonals that ``max_edits`` edits can reach. After
    each character of ``other``, bit d of state e is set if some prefix of ``one``, ending
    on diagonal d, is within e edits of what has been read. A character keeps a diagonal
    where it matches; an edit keeps it (substitution), or moves one down (insertion) or
    one up (deletion).
    """
    width = 2 * max_edits + 1
    every = (1 << width) - 1

    def step(acc: Column, char: Column, chars: Column) -> Column:
        same = F.lit(0)
        for d in range(width):
            at = acc["read"] + (d - max_edits)
            hit = F.when(F.get(chars, at) == char, 1 << d).otherwise(0)
            same = same.bitwiseOR(hit)
        states = [acc["s0"].bitwiseAND(same)]
        for e in range(1, max_edits + 1):
            before = acc[f"s{e - 1}"]
            inserted = F.shiftright(before, 1)
            deleted = F.shiftleft(states[e - 1], 1)
            state = acc[f"s{e}"].bitwiseAND(same).bitwiseOR(before).bitwiseOR(inserted)
            states.append(state.bitwiseOR(deleted).bitwiseAND(F.lit(every)))
        named = [state.alias(f"s{e}") for e, state in enumerate(states)]
        return F.struct((acc["read"] + 1).alias("read"), *named)

    def last(texts: Column) -> Column:
        start = F.struct(
            F.lit(0).alias("read"),
            *(
                F.lit(sum(1 << (max_edits + d) for d in range(e + 1))).alias(f"s{e}")
                for e in range(max_edits + 1)
            ),
        )
        end = F.aggregate(
            texts["other"], start, lambda acc, char: step(acc, char, texts["one"])
        )
        diagonal = F.size(texts["one"]) - F.size(texts["other"]) + max_edits
        reached = F.call_function("shiftright", end[f"s{max_edits}"], diagonal)
        inside = F.abs(F.size(texts["one"]) - F.size(texts["other"])) <= max_edits
        return inside & (reached.bitwiseAND(F.lit(1)) == 1)

    texts = F.struct(one.alias("one"), other.alias("other"))
    for _ in range(HALVINGS):
        texts = F.transform(F.array(texts), _without_equal_ends)[0]
    split = F.transform(
        F.array(texts),
        lambda t: F.struct(_chars(t["one"]).alias("one"), _chars(t["other"]).alias("other")),
    )
    return F.transform(split, last)[0]


def _without_equal_ends(texts: Column) -> Column:
    """Two texts without their first halves if these are equal, and their last halves if
    those are: what edits they need is the same."""
    one, other = texts["one"], texts["other"]
    half = F.floor(F.least(F.length(one), F.length(other)) / 2).cast("int")
    front = F.when(F.left(one, half) == F.left(other, half), half).otherwise(0)
    back = F.when(F.right(one, half) == F.right(other, half), half).otherwise(0)
    ends = F.array(F.struct(front.alias("front"), back.alias("back")))

    def cut(text: Column) -> Column:
        return F.transform(
            ends, lambda e: F.substr(text, e["front"] + 1, F.length(text) - e["front"] - e["back"])
        )[0]

    return F.struct(cut(one).alias("one"), cut(other).alias("other"))


def _chars(text: Column) -> Column:
    """The characters of a text; none for an empty one."""
    return F.filter(F.split(text, ""), lambda c: c != "")
