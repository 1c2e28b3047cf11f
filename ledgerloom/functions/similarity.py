"""Token-set similarity of two names, 0 to 100."""
from pyspark.sql import Column, DataFrame, functions as F

BITS = 62  # of a row word, so that sums stay within a bigint
FULL = (1 << BITS) - 1
MARK, END = "\x01", "\x02"  # letters that no name has; texts that have one are compared by bits


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _masks(letters: Column, size: Column) -> Column:
    """For each letter of a text its places, as bits in words of 62."""
    def word(letter, w):
        places = F.sequence(w * BITS, F.least(w * BITS + BITS - 1, size - 1))
        return F.aggregate(places, _long(0), lambda m, i: F.when(
            F.get(letters, i) == letter, m.bitwiseOR(F.call_function("shiftleft", _long(1), i % BITS))).otherwise(m))
    distinct, words = F.array_distinct(letters), F.sequence(F.lit(0), F.floor((size - 1) / BITS).cast("int"))
    return F.when(size > 0, F.map_from_arrays(distinct, F.transform(distinct, lambda x: F.transform(words, lambda w: word(x, w)))))


def _in_one_word(masks: Column) -> Column:
    def step(row, mask):
        hit = row.bitwiseAND(F.coalesce(F.get(mask, F.lit(0)), _long(0)))
        return (row + hit).bitwiseOR(row - hit).bitwiseAND(_long(FULL))
    return F.lit(BITS) - F.bit_count(F.aggregate(masks, _long(FULL), step))


def _in_many_words(masks: Column, size: Column) -> Column:
    def step(rows, mask):
        def word(state, pair):
            total = pair["row"] + pair["hit"] + state["carry"]
            return F.struct(F.concat(state["rows"], F.array(total.bitwiseOR(pair["row"] - pair["hit"]).bitwiseAND(_long(FULL)))).alias("rows"),
                            F.shiftright(total, BITS).alias("carry"))
        start = F.struct(F.array().cast("array<bigint>").alias("rows"), _long(0).alias("carry"))
        pairs = F.zip_with(rows, mask, lambda row, m: F.struct(row.alias("row"), row.bitwiseAND(m).alias("hit")))
        return F.when(mask.isNull(), rows).otherwise(F.aggregate(pairs, start, word)["rows"])
    rows = F.array_repeat(_long(FULL), F.floor((size - 1) / BITS).cast("int") + 1)
    return F.aggregate(F.aggregate(masks, rows, step), F.lit(0), lambda n, row: n + BITS - F.bit_count(row))


def _by_marks(longer: Column, shorter: Column) -> Column:
    """Marks stand in the longer text behind the first place where a common subsequence of each length ends. A letter of the shorter
    text moves the mark of each piece that has the letter to its first place there; the last piece, which has no mark, gains one."""
    def step(text, letter):
        return F.regexp_replace(text, F.concat(F.lit("(\\Q"), letter, F.lit(f"\\E)([^{MARK}]+){MARK}?")), F.lit(f"$1{MARK}$2"))
    marked = F.aggregate(F.split(shorter, ""), F.concat(longer, F.lit(END)), step)
    return F.length(marked) - F.length(longer) - 1


def with_common_lengths(df: DataFrame, pairs: dict) -> DataFrame:
    """Adds the length of the longest common subsequence per entry of ``pairs``: name → (text column, text column), none of them null.

    A fold over the letters of the shorter text. Its state is the longer text
    with a mark where the common subsequence of each length ends first; each
    letter moves all marks it can in one replacement. Texts that have the mark
    itself are folded in rows of bits, one for each letter of the longer text,
    62 to a word; each letter clears the bit where the subsequence can grow, for
    all places at once, and words carry into the next. Texts may have any length.
    """
    longer = {f"_x_{s}": F.when(F.length(a) >= F.length(b), F.col(a)).otherwise(F.col(b)) for s, (a, b) in pairs.items()}
    shorter = {f"_y_{s}": F.when(F.length(a) >= F.length(b), F.col(b)).otherwise(F.col(a)) for s, (a, b) in pairs.items()}
    work = df.withColumns(shorter | longer)
    work = work.withColumns({f"_b_{s}": F.concat(f"_x_{s}", f"_y_{s}").rlike(f"[{MARK}{END}]") for s in pairs})
    work = work.withColumns({f"{c}_letters": F.when(F.col(f"_b_{c[3:]}"), F.split(c, "")) for c in (*shorter, *longer)})
    work = work.withColumns({f"_m_{s}": F.when(F.col(f"_b_{s}"), _masks(F.col(f"_x_{s}_letters"), F.length(f"_x_{s}"))) for s in pairs})
    # The places of each letter of the shorter text; null if the longer has none. The masks are named twice, as a column that
    # is named once would be put in place of its name, here into the loop over the letters.
    work = work.withColumns({f"_f_{s}": F.when(F.col(f"_m_{s}").isNotNull(), F.transform(f"_y_{s}_letters", _place_of(F.col(f"_m_{s}")))) for s in pairs})
    out = {}
    for s in pairs:
        size, masks = F.length(f"_x_{s}"), F.col(f"_f_{s}")
        bits = F.when(size <= BITS, _in_one_word(masks)).otherwise(_in_many_words(masks, size))
        out[s] = F.when(F.length(f"_y_{s}") == 0, 0).when(F.col(f"_b_{s}"), bits).otherwise(_by_marks(F.col(f"_x_{s}"), F.col(f"_y_{s}"))).cast("int")
    return work.withColumns(out).select(*df.columns, *pairs)


def _place_of(masks: Column):
    return lambda letter: F.try_element_at(masks, letter)


def _tokens(c: Column) -> Column:
    words = F.split(F.trim(F.regexp_replace(F.lower(c), r"(?U)\W", " ")), r"\s+")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: w != "")))


def _ratio(common: Column, total: Column) -> Column:
    return F.rint(F.try_divide(F.lit(200.0) * common, total)).cast("int")


def with_token_scores(df: DataFrame, pairs: dict) -> DataFrame:
    """Adds a score per entry of ``pairs``: score name → (column, column).

    A score is the best of three comparisons among: the shared words, the
    shared words plus the rest of one name, and plus the rest of the other. The
    first is a prefix of the other two, so only the two rests need a common
    subsequence, and only where it can decide. Words are split once per column, and each step is a projection
    of its own, so no step is computed twice.
    """
    names = list(dict.fromkeys(c for pair in pairs.values() for c in pair))
    work = df.withColumns({f"_w_{c}": _tokens(F.col(c)) for c in names})
    parts = {}
    for score, (a, b) in pairs.items():
        x, y = F.col(f"_w_{a}"), F.col(f"_w_{b}")
        parts[f"_s_{score}"] = F.array_join(F.array_intersect(x, y), " ")
        parts[f"_a_{score}"] = F.array_join(F.array_except(x, y), " ")
        parts[f"_b_{score}"] = F.array_join(F.array_except(y, x), " ")
    work = work.withColumns(parts)
    sizes, known, open_ = {}, {}, {}
    for s in pairs:
        n, na, nb = F.length(f"_s_{s}"), F.length(f"_a_{s}"), F.length(f"_b_{s}")
        gap_a = F.when((n > 0) & (na > 0), 1).otherwise(0)
        gap_b = F.when((n > 0) & (nb > 0), 1).otherwise(0)
        whole_a, whole_b = n + na + gap_a, n + nb + gap_b
        shared = n + F.least(gap_a, gap_b)
        known[f"_k_{s}"] = F.greatest(F.when(n > 0, _ratio(n, n + whole_a)).otherwise(0), F.when(n > 0, _ratio(n, n + whole_b)).otherwise(0))
        # The rests have at most as much in common as the shorter is long: often too little for the third comparison to count.
        open_[f"_o_{s}"] = F.coalesce(_ratio(shared + F.least(na, nb), whole_a + whole_b) > F.col(f"_k_{s}"), F.lit(False))
        sizes[s] = (whole_a, whole_b, shared)
    work = work.withColumns(known).withColumns(open_)
    work = work.withColumns({f"_{side}r_{s}": F.when(F.col(f"_o_{s}"), F.col(f"_{side}_{s}")).otherwise("") for s in pairs for side in "ab"})
    work = with_common_lengths(work, {f"_c_{s}": (f"_ar_{s}", f"_br_{s}") for s in pairs})
    scores = {}
    for s, (whole_a, whole_b, shared) in sizes.items():
        best = F.greatest(f"_k_{s}", F.when(F.col(f"_o_{s}"), _ratio(shared + F.col(f"_c_{s}"), whole_a + whole_b)).otherwise(0))
        # A missing or wordless name scores nothing.
        scores[s] = F.coalesce(F.when((whole_a > 0) & (whole_b > 0), best), F.lit(0))
    return work.withColumns(scores).select(*df.columns, *pairs)
