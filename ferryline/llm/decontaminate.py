"""Benchmark decontamination by template canonicalisation.

Texts are cut into words and whole values: a number with its sign, separators and decimals
is one, and so is a run of capitalised words (a name). Numbers, numbers with a unit, units after
a number and names become typed placeholders, other words are lower-cased.
Windows of ``window`` such template words are hashed and joined with the windows of
the benchmark, so a question whose numbers and names were changed still meets its
original. Two figures decide for each place where an item aligns with a row: coverage, the share of the item's
windows found there, and slot consistency, the share of the item's slot values that map to
one value each, unlike the others'. A verbatim leak maps every value to itself, a re-parameterised
one to a consistent other value; chance meetings of templates map at random. One
alignment that reaches both figures is enough, whatever else the row holds.

A capital is all that tells a name, so every text is searched in a second form too, folded
to lower case with names as plain words: copies in lower case, in capitals or as a title
meet the folded windows. An item leaks when either form reaches both figures.

A window with fewer than ``min_literals`` literal words is not searched unless its
item has no other. Items shorter than the window are searched as one window of their
own length. Items under ``min_words`` words are matched exactly, all words in a row in any
case; templates of so few words are not searched, as they would meet anything.

The windows of a text stay inside its row: a bitmap of the benchmark's hashes (built
from the benchmark alone, half a MB for each form at most) drops nearly all before anything is exploded,
and the rest joins the benchmark on the full hash. The benchmark's windows are
broadcast only when their counted number is under ``BROADCAST_WINDOWS``.

Results for odd input: NULL and empty texts, and an empty benchmark, leak nothing;
NULL items are skipped; repeated items count as separate ones by ``item_id``, repeated
rows are judged each for itself; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.rows import col, numbered, unpacked
from ferryline.shared import materialize

WINDOW, MIN_LITERALS, MIN_WORDS = 8, 4, 5
COVERAGE, CONSISTENCY = 0.5, 0.8
#: Words put in or left out at one place before a row's windows count as another alignment.
SLIP = 3
#: Benchmarks with more windows than this are joined by shuffling.
BROADCAST_WINDOWS = 200_000
#: Bits of the bitmap for each window, and the least and most words of 64 bits as powers of two. Benchmarks
#: of over 65,536 windows fill more of the largest one and pass more windows on.
BITS_PER_WINDOW, LEAST_WORDS, MOST_WORDS = 64, 10, 16

_NUMBER = r"(?:(?<![\p{L}\p{N}])[+\-\u2212]?\.?)?[0-9]++(?:[.,'\u2019\u00a0\u202f][0-9]++)*+"
_WORD = r"[\p{L}\p{N}]++"
_NAME = r"[\p{Lu}\p{Lt}][\p{L}\p{N}]*+"
# Possessive throughout: a text in capitals is one long run, and must not recurse.
_NAMES = rf"{_NAME}(?:(?:[\s\u00a0\-]++|['\u2019]){_NAME})*+"
#: What lies between words: a run of other characters, but for a single mark between two digits.
_BETWEEN = r"[^\p{L}\p{N}]++(?<![0-9][.,'\u2019\u00a0\u202f](?=[0-9]))"
IS_NUMBER = r"^[+\-\u2212.]*[0-9][0-9.,'\u2019\u00a0\u202f]*$"
# Unit words that follow a number.
UNITS = ("mm cm m km in ft yd mi g kg mg t lb oz l ml s ms min h hr hrs sec secs second seconds "
         "minute minutes hour hours day days week weeks month months year years percent "
         "dollar dollars cent cents euro euros eur usd gbp pound pounds meter meters metre "
         "metres kilometer kilometers mile miles inch inches foot feet gram grams kilogram "
         "kilograms liter liters litre litres degree degrees mph kmh hz khz mhz ghz kb mb gb tb "
         "w kw v volt volts watt watts").split()
#: The two forms of a text: with names as placeholders, or folded to lower case.
TEMPLATE, FOLDED = 0, 1
NUMBER, MEASURE, UNIT, NAME = "\x01number", "\x01measure", "\x01unit", "\x01name"


def words(text: Column, mode: int) -> Column:
    """Words and values; runs of names are one word in templates.

    Folded texts are split at what lies between words, which is less work than finding words; signs
    before numbers are not kept there.
    """
    if mode == FOLDED:
        return F.array_remove(F.split(F.lower(text), _BETWEEN, -1), "")
    return F.regexp_extract_all(text, F.lit(rf"{_NUMBER}[\p{{L}}\p{{N}}]*+|{_NAMES}|{_WORD}"), F.lit(0))


def slot_value(value: Column) -> Column:
    """A lower-cased slot value: a number without separators, or the last word of a name.

    A run of names can begin with the word that opens a sentence.
    """
    return F.when(value.rlike("^[+\\-\u2212.]*[0-9]"), F.regexp_replace(value, "[+,'\u2019\u00a0\u202f]", "")
                  ).otherwise(F.regexp_extract(value, r"([\p{L}\p{N}]+)$", 1))


#: What a number, or a number with a unit, begins with; words begin with letters.
_DIGIT_FIRST = [*"0123456789+-.\u2212"]
_JOINT = "\x02"


def template(tokens: Column, mode: int) -> Column:
    """The hash of each word's form."""
    lowered = tokens if mode == FOLDED else F.when(F.size(tokens) > 0, F.split(
        F.lower(F.array_join(tokens, _JOINT)), _JOINT, -1)).otherwise(tokens)

    def form(w: Column, i: Column) -> Column:
        first = F.substring(w if mode == FOLDED else F.get(tokens, i), 1, 1)
        after_number = F.when(i > 0, F.get(tokens, i - 1).rlike(IS_NUMBER)).otherwise(False)
        typed = F.when(first.isin(_DIGIT_FIRST), F.when(w.rlike(IS_NUMBER), NUMBER).otherwise(MEASURE)).when(
            w.isin(UNITS) & after_number, UNIT)
        if mode == TEMPLATE:
            typed = typed.when(F.lower(first) != first, NAME)
        return F.xxhash64(typed.otherwise(w))

    return F.transform(lowered, form)


def window_hash(forms: Column, start: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(forms, start + k) for k in range(length)])


def benchmark_windows(benchmark: DataFrame, item_id: str, text: str, window: int,
                      min_literals: int, min_words: int) -> DataFrame:
    """Stored ``(item_id, mode, exact, ipos, size, hash, forms, raw, slots, windows)`` of every item and form."""
    slot_hashes = F.array(*[F.xxhash64(F.lit(x)) for x in (NUMBER, MEASURE, UNIT, NAME)])
    stored = numbered(benchmark.where(col(text).isNotNull()), col(item_id).alias("item_id"),
                      col(text).alias("body"), only=[], purpose="items")
    items = None
    for mode in (TEMPLATE, FOLDED):
        one = stored.select(F.col("uid").alias("item"), "item_id", F.lit(mode).alias("mode"),
                            words(F.col("body"), mode).alias("raw")).withColumn("forms", template(F.col("raw"), mode))
        items = one if items is None else items.unionAll(one)
    exact = (F.col("mode") == FOLDED) & (F.size("raw") < min_words)
    items = items.where((F.size("raw") >= min_words) | exact & (F.size("raw") > 0)).withColumn("exact", exact).withColumn("size", F.least(F.size("raw"), F.lit(window)))
    at = items.select("item", "item_id", "mode", "exact", "size", F.explode(F.sequence(F.lit(0), F.size("raw") - F.col("size"))).alias("ipos"),
                      "forms", "raw")
    cut = at.select(
        "item", "item_id", "mode", "exact", "ipos", "size",
        F.slice("forms", F.col("ipos") + 1, F.col("size")).alias("forms"),
        F.transform(F.slice("raw", F.col("ipos") + 1, F.col("size")), F.lower).alias("raw"),
    ).withColumn("slots", F.filter(F.sequence(F.lit(0), F.col("size") - 1),
                                   lambda k: F.array_contains(slot_hashes, F.get("forms", k))))
    literal = F.col("exact") | (F.col("size") - F.size("slots") >= F.least(F.lit(min_literals), F.col("size")))
    best = cut.groupBy("item", "mode").agg(F.max(literal).alias("any"),
                                   F.sum(literal.cast("long")).alias("good"), F.count(F.lit(1)).alias("all"))
    hashes = F.coalesce(*[F.when(F.col("size") == n, window_hash(F.col("forms"), F.lit(0), n))
                          for n in range(1, window + 1)])
    return materialize(
        cut.join(best, ["item", "mode"]).where(literal | ~F.col("any")).select(
            "item", "item_id", "mode", "exact", "ipos", "size", hashes.alias("hash"), "forms", "raw", "slots",
            F.when(F.col("any"), F.col("good")).otherwise(F.col("all")).alias("windows")),
        "benchmark")


class Bitmap:
    """A bit for each bucket of hashes, set where the benchmark has a window.

    The leading bits of a hash choose the word, the last six its bit. It is one constant array in the
    plan, of at most ``2 ** MOST_WORDS`` words whatever the benchmark.
    """

    def __init__(self, index: DataFrame, windows: int):
        self.power = min(max((windows * BITS_PER_WINDOW >> 6).bit_length(), LEAST_WORDS), MOST_WORDS)
        words = [0] * (1 << self.power)
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("hash").bitwiseAND(F.lit(63)).cast("int"))
        for place, bits in index.groupBy(self._word(F.col("hash"))).agg(F.bit_or(bit)).collect():
            words[place] = bits
        self.words = F.split(F.lit(",".join(map(str, words))), ",", -1).cast("array<bigint>")

    def _word(self, value: Column) -> Column:
        return F.shiftrightunsigned(value, 64 - self.power).cast("int")

    def has(self, value: Column) -> Column:
        return F.getbit(F.get(self.words, self._word(value)), value.bitwiseAND(F.lit(63)).cast("int")) == 1


def find_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text",
               item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
               min_literals: int = MIN_LITERALS, min_words: int = MIN_WORDS,
               coverage: float = COVERAGE, consistency: float = CONSISTENCY,
               keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The stored rows ``(uid, doc)`` and the leaks ``(uid, item, item_id, coverage, consistency)``."""
    index = benchmark_windows(benchmark, item_id, item_text, window, min_literals, min_words)
    sizes = {TEMPLATE: [], FOLDED: []}
    for mode, size in index.select("mode", "size").distinct().orderBy("mode", "size").collect():
        sizes[mode].append(size)
    n = index.count()
    small = n <= BROADCAST_WINDOWS
    bitmaps = {m: Bitmap(index.where(F.col("mode") == m), n) for m in sizes if sizes[m]}

    def hits(forms: Column, raw: Column, mode: int, size: int) -> Column:
        places = F.when(F.size(forms) >= size, F.sequence(F.lit(0), F.size(forms) - F.lit(size)))
        # Hashes are made once for all windows, and again for the few that pass.
        hashes = F.transform(places, lambda i: window_hash(forms, i, size))
        kept = F.array_compact(F.transform(hashes, lambda h, i: F.when(bitmaps[mode].has(h), i)))
        return F.coalesce(F.transform(kept, lambda i: F.struct(
            F.lit(mode).alias("mode"), i.alias("pos"), F.lit(size).alias("size"), window_hash(forms, i, size).alias("hash"),
            F.slice(forms, i + 1, F.lit(size)).alias("forms"),
            F.slice(raw, i + 1, F.lit(size)).alias("raw"))), F.array())

    def found(raw: Column, mode: int) -> Column:
        """Words and forms are bound once each, through lambdas over single-element arrays."""
        forms = F.transform(F.array(raw), lambda r: F.struct(r.alias("raw"), template(r, mode).alias("forms")))
        return F.get(F.transform(forms, lambda x: F.flatten(F.array(
            *[hits(x["forms"], x["raw"], mode, s) for s in sizes[mode]]))), F.lit(0))

    none = F.lit(None).cast("array<struct<mode:int,pos:int,size:int,hash:bigint,forms:array<bigint>,raw:array<string>>>")
    both = [found(words(col(text).cast("string"), m), m) for m in sizes if sizes[m]]
    # NULL texts have no hits in either form.
    rows = numbered(df, (F.concat(*both) if both else none).alias("hits"), only=keep,
                    purpose="decontaminate")

    met = rows.select("uid", F.explode("hits").alias("h")).select(
        "uid", "h.mode", "h.pos", "h.size", "h.hash", F.col("h.forms").alias("their_forms"),
        F.col("h.raw").alias("their_raw"))
    # Stored rows are many times larger than their files, so sizes of files must not choose a broadcast.
    index = F.broadcast(index) if small else index.hint("merge")
    met = met.join(index, ["mode", "size", "hash"]).where(
        (F.col("their_forms") == F.col("forms")) & (~F.col("exact") | (F.col("their_raw") == F.col("raw")))).select(
        "uid", "item", "item_id", "mode", "windows", "ipos", (F.col("pos") - F.col("ipos")).alias("shift"),
        F.transform("slots", lambda k: F.struct(
            slot_value(F.get("raw", k)).alias("ours"),
            slot_value(F.lower(F.get("their_raw", k))).alias("theirs"))).alias("pairs"))
    return rows, aligned_leaks(materialize(met, "met"), coverage, consistency)


def aligned_leaks(met: DataFrame, coverage: float, consistency: float) -> DataFrame:
    """``(uid, item, item_id, coverage, consistency)`` of the items that leak by one of their alignments.

    Windows of one alignment lie at the same distance from their places in the item, or at one that
    differs by at most ``SLIP`` words from the next (words put in or left out). An alignment is judged by
    itself: chance hits elsewhere in the row neither add to it nor speak against it.
    """
    by_item = ["uid", "item", "item_id", "mode", "windows"]
    in_order = Window.partitionBy("uid", "item", "mode").orderBy("shift")
    apart = F.col("shift") - F.lag("shift").over(in_order) > SLIP
    # Windows at one distance are peers in this order, so they get the same run.
    met = met.withColumn("run", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(in_order))
    covered = met.select(*by_item, "run", "ipos").distinct().groupBy("uid", "item", "item_id", "mode", "run").agg(
        (F.count(F.lit(1)) / F.first("windows")).alias("coverage"))
    slots = met.select("uid", "item", "mode", "run", F.explode("pairs").alias("p")).groupBy(
        "uid", "item", "mode", "run", "p.ours").agg(
        F.when(F.min("p.theirs") == F.max("p.theirs"), F.min("p.theirs")).alias("one"))
    # Values that share their counterpart with another one count once.
    steady = slots.groupBy("uid", "item", "mode", "run").agg(
        (F.count_distinct("one") / F.count(F.lit(1))).alias("consistency"))
    judged = covered.where(F.col("coverage") >= coverage).join(
        steady.hint("merge"), ["uid", "item", "mode", "run"], "left").withColumn(
        "consistency", F.coalesce("consistency", F.lit(1.0)))
    best = judged.where(F.col("consistency") >= consistency).groupBy("uid", "item", "item_id").agg(
        F.max(F.struct("coverage", "consistency")).alias("best"))
    return best.select("uid", "item", "item_id", "best.coverage", "best.consistency")


def decontaminate(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` that leak no benchmark item."""
    rows, leaks = find_leaks(df, benchmark, **options)
    return rows.join(leaks.select("uid").distinct(), "uid", "left_anti").select(*unpacked(df.columns))
