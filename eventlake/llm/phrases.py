"""Phrases whose words keep together, mined by sampling and a negative border.

A phrase can only be frequent if its two parts of one word less are. A sample of the texts
proposes phrases; one pass over all texts counts these and their negative border, which is every
phrase whose parts are proposed. A phrase of the border that turns out frequent was missed by the
sample, and so may be longer ones built on it: further passes count those until none is
left to open.

Until then a phrase is its 64-bit hash, and which hashes are proposed is kept in a bit array of
fixed size. Hashes or bits that fall together have phrases counted in vain, and lose none: a
last pass counts the phrases that are left by their words, exactly.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import settle

#: Characters that end a piece, and that part words.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Words of the longest phrase.
LONGEST = 4
#: Bytes of text worked on at once: few enough for three word numbers to fit in 63 bits.
WINDOW = 1 << 20
#: Hashes gathered before equal ones are put together and given out.
GATHERED = 1 << 20
#: Bits of the array of proposed phrases, as a power of two, and of the parts it is built in.
FILTER_BITS, PART_BITS = 27, 15
#: Groups that a language's phrases are ranked in first.
SALTS = 128

KIND = np.zeros(256, np.uint8)
KIND[list(BLANKS)] = 1
KIND[list(ENDS)] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[list(string.ascii_uppercase.encode())] = list(string.ascii_lowercase.encode())

#: Random odd factors of a byte and of its place in a word.
OF_BYTE, OF_PLACE = np.random.default_rng(11).integers(0, 1 << 63, (2, 256), np.uint64) * 2 + 1


def mix(hashes: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole number."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        hashes = (hashes ^ hashes >> np.uint64(shift)) * np.uint64(factor)
    return hashes ^ hashes >> np.uint64(31)


class Words:
    """The words of a window of text, and the phrases that end in them. Phrases that end in
    the first ``seen`` words belong to the window before."""

    def __init__(self, lang: str, raw: np.ndarray, seen: int):
        kind = KIND[raw]
        is_word = np.zeros(len(raw) + 2, bool)
        is_word[1:-1] = kind == 0
        edges = np.flatnonzero(is_word[1:] != is_word[:-1])
        self.starts, sizes = edges[::2], edges[1::2] - edges[::2]
        self.seen = seen
        self.pieces = np.cumsum(kind == 2, dtype=np.int32)[self.starts] if len(raw) else self.starts
        self.data = LOWER[raw[is_word[1:-1]]]
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        place = np.arange(len(self.data)) - np.repeat(self.offsets[:-1], sizes)
        values = OF_BYTE[self.data] * OF_PLACE[place & 255]
        sums = np.add.reduceat(values, self.offsets[:-1]) if len(sizes) else values
        seed = np.uint64(xxhash.xxh64_intdigest(lang))
        self.hashes = [mix(sums + sizes.astype(np.uint64) + seed)]
        for _ in range(1, LONGEST):
            longer = np.zeros_like(self.hashes[0])
            longer[1:] = self.hashes[-1][:-1] * np.uint64(0x9E3779B97F4A7C15)
            self.hashes.append(mix(longer + self.hashes[0]))

    def new(self, k: int) -> np.ndarray:
        """Whether a phrase of ``k`` words, not seen before, ends in each word."""
        whole = np.arange(len(self.starts)) >= max(self.seen, k - 1)
        whole[k - 1 :] &= self.pieces[k - 1 :] == self.pieces[: len(self.pieces) - k + 1]
        return whole

    def parts(self, k: int, proposed: np.ndarray) -> np.ndarray:
        """Whether both parts, of ``k`` - 1 words, of the phrase that ends in each word are
        proposed."""
        shorter = is_set(proposed, self.hashes[k - 2])
        both = np.zeros(len(shorter), bool)
        both[1:] = shorter[:-1] & shorter[1:]
        return both

    def spelt(self) -> tuple[np.ndarray, pa.Array]:
        """The words as numbers, and the words that these stand for."""
        buffers = [None, pa.py_buffer(self.offsets), pa.py_buffer(self.data)]
        coded = pa.Array.from_buffers(pa.string(), len(self.starts), buffers).dictionary_encode()
        return coded.indices.to_numpy().astype(np.int64), coded.dictionary

    def counted(self, k: int, wanted: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The phrases of ``k`` words that end where ``wanted``, each once, and their counts."""
        numbers, words = self.spelt()
        ends = np.flatnonzero(wanted)
        key, n = numbers[ends], len(words)
        if k == LONGEST:
            first = (numbers[ends - 3] * n + numbers[ends - 2]) * n + numbers[ends - 1]
            key = np.unique(first, return_inverse=True)[1] * n + key
        else:
            for back in range(1, k):
                key = key + numbers[ends - back] * n**back
        _, at, count = np.unique(key, return_index=True, return_counts=True)
        ends = ends[at]
        each = [words.take(pa.array(numbers[ends - back])) for back in range(k - 1, -1, -1)]
        return pc.binary_join_element_wise(*each, " ") if k > 1 else each[0], count


def is_set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    found = np.ones(len(hashes), bool)
    for place in (hashes & mask, hashes >> np.uint64(64 - FILTER_BITS)):
        found &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1) > 0
    return found


def windows(batch: pa.RecordBatch) -> Iterator[tuple[str, Words]]:
    """The words of a batch of (lang, text), by language. Short texts come together, a long one
    in several windows."""
    for lang in pc.unique(batch.column(0)).to_pylist():
        texts = batch.filter(pc.equal(batch.column(0), lang)).column(1).drop_null()
        held, size = [], 0
        for text in texts:
            raw = np.frombuffer(text.as_buffer(), np.uint8) if text.as_buffer().size else None
            if raw is None:
                continue
            if size + len(raw) > WINDOW and held:
                yield lang, Words(lang, np.concatenate(held), 0)
                held, size = [], 0
            if len(raw) > WINDOW:
                yield from ((lang, words) for words in _long_text(lang, raw))
            else:
                held += [raw, np.frombuffer(b"\n", np.uint8)]
                size += len(raw) + 1
        if held:
            yield lang, Words(lang, np.concatenate(held), 0)


def _long_text(lang: str, raw: np.ndarray) -> Iterator[Words]:
    """Windows of a text end between words, or behind a word that is longer. Each but the first
    begins with the last words of the one before."""
    start = at = seen = 0
    while at < len(raw):
        end = min(at + WINDOW, len(raw))
        gaps = np.flatnonzero(KIND[raw[at:end]]) if end < len(raw) else []
        if len(gaps):
            end = at + int(gaps[-1]) + 1
        while end < len(raw) and not len(gaps):
            gaps = np.flatnonzero(KIND[raw[end : end + WINDOW]])
            end = end + int(gaps[0]) + 1 if len(gaps) else min(end + WINDOW, len(raw))
        words = Words(lang, raw[start:end], seen)
        yield words
        seen = min(len(words.starts), LONGEST - 1)
        start, at = start + int(words.starts[-seen]) if seen else end, end


def _hashes(texts: DataFrame, wanted: Callable[[Words, int], np.ndarray | None], most: int) -> DataFrame:
    """(hash, long, f) of the phrases of up to ``most`` words that are ``wanted``; ``long`` are
    those that cannot be part of another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list[np.ndarray]] = {False: [], True: []}

        def give(is_long: bool) -> pa.RecordBatch:
            hashes, count = np.unique(np.concatenate(held[is_long]), return_counts=True)
            held[is_long] = []
            arrays = [hashes.view(np.int64), np.full(len(hashes), is_long), count]
            return pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), names=["hash", "long", "n"])

        for batch in batches:
            for _, words in windows(batch):
                for k in range(1, most + 1):
                    chosen = wanted(words, k)
                    if chosen is not None:
                        held[k == LONGEST].append(words.hashes[k - 1][chosen])
                for is_long, some in held.items():
                    if sum(map(len, some)) >= GATHERED:
                        yield give(is_long)
        for is_long, some in held.items():
            if some:
                yield give(is_long)

    found = texts.mapInArrow(run, "hash bigint, long boolean, n bigint")
    return found.groupBy("hash", "long").agg(F.sum("n").alias("f"))


def sampled(texts: DataFrame) -> DataFrame:
    """(hash, long, f) of the phrases of ``texts`` that can be parts of others."""
    return _hashes(texts, lambda words, k: words.new(k), LONGEST - 1)


def bordered(texts: DataFrame, proposed: np.ndarray, before: np.ndarray | None = None) -> DataFrame:
    """(hash, long, f) of the phrases whose parts are proposed, if not all were ``before``;
    without ``before`` also of all words."""
    context = texts.sparkSession.sparkContext
    now, then = context.broadcast(proposed), context.broadcast(before)

    def wanted(words: Words, k: int) -> np.ndarray | None:
        if k == 1:
            return words.new(1) if then.value is None else None
        chosen = words.new(k) & words.parts(k, now.value)
        if then.value is not None:
            chosen &= ~words.parts(k, then.value)
        return chosen

    return _hashes(texts, wanted, LONGEST)


def spelt(texts: DataFrame, chosen: np.ndarray) -> DataFrame:
    """(lang, phrase, k, f) of the phrases whose hashes are ``chosen``, and of all words of a
    language together as phrase '' with k 0."""
    bits = texts.sparkSession.sparkContext.broadcast(chosen)

    def rows(lang: str, k: int, phrase: pa.Array, count: np.ndarray) -> pa.RecordBatch:
        n = len(phrase)
        columns = [pa.repeat(pa.scalar(lang, pa.string()), n), phrase, pa.repeat(k, n)]
        count = pa.array(count, pa.int64())
        return pa.RecordBatch.from_arrays([*columns, count], names=["lang", "phrase", "k", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words in windows(batch):
                yield rows(lang, 0, pa.array([""]), [words.new(1).sum()])
                for k in range(1, LONGEST + 1):
                    wanted = words.new(k) & is_set(bits.value, words.hashes[k - 1])
                    yield rows(lang, k, *words.counted(k, wanted))

    found = texts.mapInArrow(run, "lang string, phrase string, k bigint, n bigint")
    return found.groupBy("lang", "phrase", "k").agg(F.sum("n").alias("f"))


def proposals(hashes: DataFrame) -> np.ndarray:
    """The bits of column ``hash``. Parts of the array come to the driver: its size is fixed."""
    mask = (1 << FILTER_BITS) - 1
    places = F.array(
        F.col("hash").bitwiseAND(mask), F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    )
    parts = (
        hashes.select(F.explode(places).alias("place"))
        .groupBy(F.shiftright("place", PART_BITS).alias("part"))
        .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND((1 << PART_BITS) - 1)).alias("bits"))
    )
    bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    size = 1 << PART_BITS - 3
    for part, some in parts.collect():
        bits[part * size : (part + 1) * size] = np.frombuffer(some, np.uint8)
    return bits


def frequent(
    docs: DataFrame,
    least: int = 30,
    share: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """(lang, phrase, k, f) of every phrase of up to four words that occurs ``least`` times in
    its language, and of all words of a language as phrase '' with k 0.

    The sample is one document in ``share``, by a hash of id and text; it proposes
    phrases at four fifths of the count due there. It decides what is counted first, not what is
    found.
    """
    lang = F.coalesce(F.col(lang_col), F.lit("und")).alias("lang")
    texts = docs.select(lang, F.col(text_col).alias("text"))
    in_sample = F.pmod(F.xxhash64(id_col, text_col), F.lit(share)) == 0
    sample = docs.filter(in_sample).select(lang, F.col(text_col).alias("text"))
    lowered = max(2, least * 4 // (5 * share))
    proposed = proposals(sampled(sample).filter(F.col("f") >= lowered))
    before, chosen = None, np.zeros_like(proposed)
    while True:
        counts = bordered(texts, proposed, before).filter(F.col("f") >= least)
        found = settle(counts, "frequent-hashes")
        chosen |= proposals(found)
        parts = proposals(found.filter(~F.col("long")))
        if not (parts & ~proposed).any():
            break
        before, proposed = proposed, proposed | parts
    return spelt(texts, chosen).filter((F.col("f") >= least) | (F.col("k") == 0))


def collocations(
    docs: DataFrame,
    least: int = 30,
    top: int = 2000,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two to
    four words.

    Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line ends, and pieces
    into words at blanks and tabs. a, l and r are the counts of a phrase and of its parts before
    and behind a cut, n that of all words of the language; the score, floor(2000000 a / (l +
    r)), is the lowest of all cuts, at ties of the first. A phrase that lies in a longer one
    with at least four fifths of its count is left out. Ranks are by score, then a, both
    descending, then by the bytes of the phrase.

    A null text has no words, a null language is ``und``, rows that repeat count each time;
    a language without frequent phrases has no rows. Texts of any length are read in bounded
    parts.
    """
    known = settle(frequent(docs, least, 8, id_col, text_col, lang_col), "frequent-phrases")
    words = F.split("phrase", " ")
    longer = known.filter("k >= 2").select("lang", "phrase", "k", F.col("f").alias("a"), words.alias("words"))
    scored = _scored(longer, known.filter("k > 0").select("lang", "phrase", "f"))
    covered = (
        longer.filter("k >= 3")
        .select("lang", "a", F.explode(_inner_phrases()).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("within"))
    )
    kept = scored.join(covered, ["lang", "phrase"], "left").filter(
        "within IS NULL OR 100 * within < 80 * a"
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    in_group = F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))
    best = kept.withColumn("rank", in_group).filter(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    best = best.withColumn("rank", rank).filter(F.col("rank") <= top)
    totals = known.filter("k = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _inner_phrases() -> Column:
    """All phrases of two words or more inside a longer one."""
    words, k = F.col("words"), F.col("k").cast("int")
    return F.flatten(
        F.transform(
            F.sequence(F.lit(2), k - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), k - size + 1),
                lambda at: F.array_join(F.slice(words, at, size), " "),
            ),
        )
    )


def _scored(longer: DataFrame, known: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) at the lowest cut, in decimals, as products may pass 64 bits."""
    cut = F.col("cut")
    cuts = longer.select("*", F.explode(F.sequence(F.lit(1), F.col("k").cast("int") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "cut",
        F.array_join(F.slice("words", F.lit(1), cut), " ").alias("left"),
        F.array_join(F.slice("words", cut + 1, F.size("words")), " ").alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        part = known.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        cuts = cuts.join(part, ["lang", side])
    score = F.expr(
        "CAST(a AS DECIMAL(20, 0)) * 2000000 DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))"
    )
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("lowest")
    return cuts.groupBy("lang", "phrase", "a").agg(lowest).select(
        "lang", "phrase", "a", "lowest.l", "lowest.r", "lowest.score"
    )


ORACLE_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws
    FROM pieces
), grams AS (
    SELECT lang, k, unnest(list_transform(
        range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
    FROM words, range(1, 5) AS sizes(k)
), totals AS (
    SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang
), known AS (
    SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), longer AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM known WHERE k >= 2
), cuts AS (
    SELECT lang, phrase, a, cut, array_to_string(ws[1:cut], ' ') AS head,
           array_to_string(ws[cut + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM longer)
), scored AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r,
           CAST((2000000::HUGEINT * c.a) // (x.f + y.f) AS BIGINT) AS score
    FROM cuts c JOIN known x ON x.lang = c.lang AND x.phrase = c.head
    JOIN known y ON y.lang = c.lang AND y.phrase = c.tail
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1
), inner_phrases AS (
    SELECT lang, a, array_to_string(ws[i:i + size - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, k - size + 2)) AS i
          FROM (SELECT *, unnest(range(2, k)) AS size FROM longer))
), covered AS (
    SELECT lang, phrase, max(a) AS within FROM inner_phrases GROUP BY ALL
), kept AS (
    SELECT s.* FROM scored s LEFT JOIN covered c USING (lang, phrase)
    WHERE c.within IS NULL OR 100 * c.within < 80 * s.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
