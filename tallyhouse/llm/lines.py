"""Fuzzy line dedup: pigeonhole blocks of words, SimHash, edit similarity, one per group.

A line is normalised to its words in lower case, without ASCII punctuation and digits. Lines of
fewer than ``MIN_WORDS`` words are no passages and always stay. Lines of equal words are merged
before any are compared.

Lines are linked when at most a tenth of the longer one's words are changed, added or left out. Lines
of five to nine words are linked when one word differs and at most a tenth of the characters. Near
lines meet in a bucket (``block_keys``): of k + 1 blocks of a line that k edits cannot all touch one
is equal in both, and short lines share all words but one. Lines of 36 words and more have keys of a
sample of their shingles instead, as so many blocks with so many shifts would be too many. Those that
meet are candidates when at most ``DISTANCE`` bits of their 64-bit SimHashes over words differ. A tenth of the
words changed turns about 9 bits, so this spares edit distances of unlike lines but is no rule of its
own. Of each connected group the line that is stored first stays.

Null text stays null, an empty text has one line of no words, equal lines and repeated rows are ties
that the stored order breaks, an empty table gives an empty one, and columns of ``docs`` may have any names.

Only DataFrame functions are used.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import FEW, cut_lineage, free_name, numbered
from tallyhouse.llm.linking import link, open_buckets, shared

MIN_WORDS = 5
#: SimHash bits that may differ; edits of a tenth of the words turn 9 of 64 on average, seldom 20 (see README).
DISTANCE = 20
#: Edited words allowed per word of the longer line, as a fraction.
EDITS = (1, 10)
#: Lines of fewer words may differ in one word, by that fraction of the characters.
WHOLE_WORDS = 10
#: Edits to expect of the longest lines that are cut into blocks; more words are sampled.
MOST_EDITS = 3
#: Of longer lines the shingles that begin with the words of smallest hashes are keys: how many, of how many
#: words, and how few words the last of a line may have. Of pairs at the edit limit 1 in 2,000 shares none.
SAMPLED, SHINGLE, LEAST_SHINGLE = 12, 6, 4
#: Members of an open bucket that one task compares with as many others.
BLOCK = 2000
#: Open buckets of more members are dealt anew by the rarest words of each line.
FEW_MEMBERS = 128
COMMON = (16, 64, 256, 1024, 4096, 16384, 65536)  # a word is the more common the more of these it is said more often than
FIRSTS = (8, 16, 32, 48, 64)  # words whose parity bits spare lines a comparison, besides those of all pairs
COUNTED = 127  # words that counters of eight bits count


def words_of(line: Column) -> Column:
    """The words of a line that is in lower case already."""
    return F.array_remove(F.split(line, r"[\x00-`{-\x7F]+"), "")


def _characters(line: Column) -> Column:
    """The characters of a text, none of an empty one."""
    return F.array_remove(F.split(line, ""), "")


def _spelled(words: Column) -> Column:
    """A text with one character for each word, so that edits of words are edits of characters. Two
    words share a character with a chance of one in a million."""
    codes = F.transform(words, lambda w: F.hex(F.pmod(F.xxhash64(w), F.lit(15 << 16)) + (1 << 16)))  # of five digits
    return F.decode(F.unhex(F.concat(F.lit("000"), F.array_join(codes, "000"))), "UTF-32")


def _without(line: Column, words: Column) -> Column:
    """A spelled line without the words of another."""
    return F.call_function("translate", line, words, F.lit(""))


def _once(value: Column) -> Column:
    """A generated column, which later expressions read instead of computing the value again."""
    return F.explode(F.array(value))


def simhashes(df: DataFrame) -> DataFrame:
    """Columns id and sim, the 64-bit SimHash of the words of each row of ``df`` (id, words); none of no words.

    A word is a row for as long as its task counts it. Sum k of eight counts bits k, k + 8 and so on of up to
    ``COUNTED`` words in counters of eight bits. Those of longer lines are added up in counters of 32 bits, a
    row for each k: steps of wide rows make methods that take a compiler gigabytes.
    """
    each = df.select("id", F.size("words").alias("n"), F.posexplode("words").alias("at", "word"))
    each = each.select("id", "n", F.floor(F.col("at") / COUNTED).alias("part"), F.xxhash64("word").alias("h"))
    ones = F.lit(0x0101010101010101)
    counted = each.groupBy("id", "n", "part").agg(*[F.sum(F.shiftrightunsigned("h", k).bitwiseAND(ones)).alias(f"s{k}") for k in range(8)])
    counted = cut_lineage(counted, "counted")
    top = F.lit(-(1 << 63))

    def majority(counters: Column, bits: int) -> Column:
        """The highest bit of each counter moved to its lowest, set where the count is more than half of n.

        Adding to each counter what a bare majority lacks to its highest bit sets that bit where there
        is one. The highest bit of all is turned before and after, so that no sum overflows.
        """
        ones = sum(1 << (bits * lane) for lane in range(64 // bits))
        lacking = (F.lit(ones) * ((1 << (bits - 1)) - 1 - F.floor(F.col("n") / 2))).bitwiseOR(top)
        return F.shiftrightunsigned((counters + lacking).bitwiseXOR(top), bits - 1).bitwiseAND(F.lit(ones))

    few = [F.shiftleft(majority(F.col(f"s{k}"), 8), k) for k in range(8)]
    short = counted.where(f"n <= {COUNTED}").select("id", functools.reduce(Column.bitwiseOR, few).alias("sim"))
    long = counted.where(f"n > {COUNTED}").select("id", "n", F.posexplode(F.array(*[f"s{k}" for k in range(8)])).alias("k", "s"))
    pair = F.lit(0x000000FF000000FF)
    wide = long.groupBy("id", "n", "k").agg(*[F.sum(F.shiftrightunsigned("s", 8 * j).bitwiseAND(pair)).alias(f"s{j}") for j in range(4)])
    set_bits = functools.reduce(Column.bitwiseOR, [F.shiftleft(majority(F.col(f"s{j}"), 32), 8 * j) for j in range(4)])
    found = wide.select("id", F.call_function("shiftleft", set_bits, F.col("k")).alias("sim")).groupBy("id").agg(F.bit_or("sim").alias("sim"))
    return short.union(found)


def with_simhash(df: DataFrame, words: Column) -> DataFrame:
    """Adds ``sim``, the 64-bit SimHash of an array of words of any length."""
    named = cut_lineage(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.monotonically_increasing_id().alias("id"), words.alias("words")), "named")
    found = named.select("id", "row").join(simhashes(named), "id", "left")
    return found.select("row.*", F.coalesce("sim", F.lit(0)).alias("sim"))


def _block_starts(n: int, m: int, edits: int) -> list[tuple[int, int]]:
    """Number and start of the blocks of ``m`` words in which two lines may agree after ``edits`` edits.

    Of blocks 0 to ``edits`` of the shorter line one, i, is untouched with exactly i edits before it
    (the first at which the edits so far fall behind the blocks so far), so at most ``edits`` - i
    follow. It lies at most i words from its place in the one line, counted from the front, or
    ``edits`` - i words, counted from the back.
    """
    starts = []
    for i in range(edits + 1):
        after = edits - i
        at = i * m if i <= after else n - (after + 1) * m
        starts += [(i, at + shift) for shift in range(-min(i, after), min(i, after) + 1)]
    return starts


def _blocks(n: int) -> list[int]:
    """Blocks of a line of n words, each as edits and number of block, start (6 bits) and words (6 bits).

    The longer line says how many words may be edited, so a line has keys for its own number of
    edits and for that of the longest line it may be linked with. Blocks are as long as the shorter
    line allows; the longer one has those of each length that the shorter may have.
    """
    found = []
    for edits in range(1, MOST_EDITS + 1):
        if n * 10 // 9 >= 10 * edits and n < 10 * (edits + 1):
            lengths = {n // (edits + 1)} | ({(n - edits) // (edits + 1)} if n >= 10 * edits else set())
            found += [(edits * 4 + i, at, m) for m in sorted(lengths) for i, at in _block_starts(n, m, edits) if 0 <= at <= n - m]
    return list(dict.fromkeys((kind << 12) + (at << 6) + m for kind, at, m in found))


def _cut_keys(words: Column) -> Column:
    """Keys of a line that is not too long to be cut into blocks, and null in places that it has no block for.
    Compiled code, as no part of it is within a higher-order function."""
    n = F.size(words)
    blocks = [_blocks(k) for k in range(10 * (MOST_EDITS + 1))]
    table = F.expr("array(" + ", ".join(f"cast(array({', '.join(map(str, b))}) as array<int>)" for b in blocks) + ")")

    def all_but(i: int) -> Column:
        rest = F.xxhash64(F.lit(0), F.lit(i), F.slice(words, 1, i), F.slice(words, F.lit(i + 2), F.greatest(n - i - 1, F.lit(0))))
        return F.when(n > i, rest)

    def block(k: int) -> Column:
        which = F.get(F.get(table, n), F.lit(k))
        at, m = F.shiftright(which, 6).bitwiseAND(F.lit(63)), which.bitwiseAND(F.lit(63))
        return F.when(which.isNotNull(), F.xxhash64(F.shiftright(which, 12), F.slice(words, at + 1, m)))

    short = F.array(*[all_but(i) for i in range(WHOLE_WORDS - 1)])
    some = F.array(*[block(k) for k in range(max(map(len, blocks)))])
    both = F.when(n < WHOLE_WORDS - 1, short).when(n < WHOLE_WORDS, F.concat(short, some)).when(n < len(blocks), some)
    return F.array_distinct(both)


def _hashes(words: Column) -> Column:
    """Hashes of the words of lines that have sampled keys, else null."""
    long = F.floor(F.size(words) * 10 / 9) >= 10 * (MOST_EDITS + 1)
    return F.when(long, F.transform(words, lambda w: F.xxhash64(w)))


def _smallest(hashes: Column) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, SAMPLED)


def _sampled_keys(hashes: Column, smallest: Column) -> Column:
    """Keys of the shingles that begin with the words of smallest hashes; null where a line ends too soon."""

    def shingle(k: int) -> Column:
        at = F.call_function("array_position", hashes, F.get(smallest, F.lit(k))).cast("int")
        return F.when(at <= F.size(hashes) - LEAST_SHINGLE + 1, F.xxhash64(F.lit(MOST_EDITS + 1), F.slice(hashes, at, SHINGLE)))

    return F.when(hashes.isNotNull(), F.array_distinct(F.array(*[shingle(k) for k in range(SAMPLED)])))


def block_keys(words: Column) -> Column:
    """Bucket keys of a line: an array that two lines share an entry of when the rule may link them."""
    none = F.array().cast("array<bigint>")
    hashes = _hashes(words)
    return F.array_compact(F.concat(F.coalesce(_cut_keys(words), none), F.coalesce(_sampled_keys(hashes, _smallest(hashes)), none)))


def _near(a: str, b: str) -> Column:
    """Whether two lines' lengths and hashes allow a link."""
    short = F.expr(f"{a}.n = {b}.n and {a}.n < {WHOLE_WORDS}")
    bits = F.expr(f"bit_count({a}.sim ^ {b}.sim) <= {DISTANCE}")
    return short | bits & F.expr(f"{EDITS[1]} * abs({a}.n - {b}.n) <= {EDITS[0]} * greatest({a}.n, {b}.n)")


def _linked(a: str, b: str) -> Column:
    """Whether two lines are linked, by their words or, of few words, by their characters."""

    def within(column: str) -> str:
        x, y = f"{a}.{column}", f"{b}.{column}"
        return f"levenshtein({x}, {y}, cast(floor(greatest(length({x}), length({y})) * {EDITS[0]} / {EDITS[1]}) as int)) >= 0"

    one_word = f"levenshtein({a}.line, {b}.line, 1) >= 0"
    short = f"{a}.n = {b}.n and {a}.n < {WHOLE_WORDS}"
    return F.expr(f"case when {short} then {one_word} and {within('chars')} else {within('line')} end")


def _by_rare_words(still: DataFrame, facts: DataFrame) -> DataFrame:
    """Open buckets (key, id, comp) that any two lines of a large bucket still share when they may be
    linked, but that lines with no more than a passage in common seldom do.

    Of a line of n words an edit distance within the rule leaves out at most n / 10, whichever of the
    two is longer. So in any one order of all words the first that both lines have is among the first
    n / 10 + 1 of either; a word said twice takes two places. The order is by how common the words are
    in all lines that are dealt anew: the words of a passage that many of them share come late. A line is
    one character a word, and the common ones are texts of such characters, so each line is put in order
    where it lies. Lines of fewer than nine words keep their buckets, as they are linked by characters.
    """
    large = cut_lineage(still.groupBy("key").agg(F.count(F.lit(1)).alias("all")).where(f"all > {FEW_MEMBERS}").select("key"), "large")
    if large.isEmpty():
        return still
    marked = still.join(large.withColumn("large", F.lit(True)), "key", "left").join(facts.select("id", "n"), "id")
    moved = F.col("large").isNotNull() & (F.col("n") >= WHOLE_WORDS - 1)
    marked = cut_lineage(marked.select("key", "id", "comp", moved.alias("moved")), "marked")
    spelled = marked.where("moved").groupBy("id").agg(F.first("comp").alias("comp"))
    spelled = cut_lineage(spelled.join(facts.select("id", "n", "line"), "id"), "spelled")
    said = spelled.select(F.explode(F.split("line", "")).alias("word"))
    counts = said.groupBy("word").agg(F.count(F.lit(1)).alias("times")).where(f"times > {COMMON[0]}")
    # At most a million words have characters of their own, so this is a row of a few MB.
    levels = [F.array_join(F.collect_list(F.when(F.col("times") > k, F.col("word"))), "").alias(f"over_{k}") for k in COMMON]
    common = cut_lineage(counts.agg(*levels), "common")
    left = [_without(F.col("line"), F.col(f"over_{k}")).alias(f"rarer_{k}") for k in COMMON]
    spelled = spelled.crossJoin(F.broadcast(common)).select("id", "comp", "n", "line", *left)
    rarer = [F.lit(""), *[F.col(f"rarer_{k}") for k in COMMON], F.col("line")]
    of_level = [_without(more, fewer) for fewer, more in zip(rarer, rarer[1:])]
    ordered = F.concat(*[F.sort_array(_characters(x)) for x in of_level])
    need = F.greatest(F.floor(F.col("n") / 10), F.lit(1)).cast("int") + 1  # of nine words one may be another
    first = F.array_distinct(F.slice(ordered, F.lit(1), need))
    dealt = spelled.select("id", "comp", F.explode(first).alias("word")).select(F.xxhash64("word").alias("key"), "id", "comp")
    dealt = open_buckets(cut_lineage(dealt, "dealt"))
    columns = ["key", "id", "comp"]
    return cut_lineage(marked.where("not moved").select(*columns).union(dealt.select(*columns)), "open")


def _marks(ids: DataFrame, facts: DataFrame) -> DataFrame:
    """Parity bits of lines: bit i is set when an odd number of hashes is i. Two longs over all pairs of
    neighbouring words, one each over the first words."""
    words = ids.join(facts.select("id", "line"), "id").select("id", _once(_characters(F.col("line"))).alias("words"))
    hashes = F.transform("words", lambda w, i: F.struct(F.xxhash64(w).alias("word"), F.xxhash64(w, F.get("words", i + 1)).alias("pair")))
    each = words.select("id", F.size("words").alias("n"), F.posexplode(hashes).alias("at", "h")).select("id", "n", "at", "h.word", "h.pair")

    def parity(of: str, chosen: str) -> Column:
        return F.expr(f"bit_xor(case when {chosen} then shiftleft(1L, cast({of} & 63 as int)) else 0L end)")

    pairs = [parity("pair", f"at < n - 1 and pair & 64 {is_} 0").alias(m) for is_, m in (("=", "pairs_0"), ("!=", "pairs_1"))]
    return each.groupBy("id").agg(*pairs, *[parity("word", f"at < {k}").alias(f"first_{k}") for k in FIRSTS])


def _explained() -> Column:
    """Whether as few edits as the rule allows can be all that two lines' marks (x, y) differ by.

    An edit takes up to two pairs from a line and brings up to two. Of a line's first words it changes
    two: one is replaced, or one more or less moves the last one out or in.
    """
    edits = f"greatest(floor(greatest(x.n, y.n) * {EDITS[0]} / {EDITS[1]}), 1)"  # of few words one may be another
    pairs = " + ".join(f"bit_count(x.{m} ^ y.{m})" for m in ("pairs_0", "pairs_1"))
    return F.expr(" and ".join([f"{pairs} <= 4 * {edits}", *[f"bit_count(x.first_{k} ^ y.first_{k}) <= 2 * {edits}" for k in FIRSTS]]))


def _met_in_blocks(still: DataFrame, facts: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of near members of open buckets (key, id, comp) that are of different groups.

    The members outside a bucket's largest group are compared with all members, block by block, so
    that no task gets a whole bucket; a pair of several buckets comes from the one with the least key. With
    ``marks`` of all members pairs are left out that no edits within the rule explain.
    """
    groups = still.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    sizes = groups.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("main"), F.sum("n").alias("all"))
    blocks = sizes.select(
        "key",
        F.col("main.comp").alias("main"),
        F.ceil(F.col("all") / BLOCK).cast("int").alias("of_all"),
        F.ceil((F.col("all") - F.col("main.n") + 1) / BLOCK).cast("int").alias("of_few"),
    )
    facts = facts.select("id", "sim", "n").join(still.groupBy("id").agg(F.collect_list("key").alias("keys")), "id")
    names = [] if marks is None else marks.columns[1:]
    placed = cut_lineage(still.join(blocks, "key").join(facts if marks is None else facts.join(marks, "id"), "id"), "placed")
    few = F.pmod(F.xxhash64("id"), F.col("of_few")).cast("int")
    every = F.pmod(F.xxhash64("id"), F.col("of_all")).cast("int")
    columns = ["key", "id", "comp", "main", "sim", "n", "keys", *names]
    x = placed.where("comp != main").select(*columns, few.alias("i"), F.explode(F.sequence(F.lit(0), F.col("of_all") - 1)).alias("j")).alias("x")
    y = placed.select(*columns, F.explode(F.sequence(F.lit(0), F.col("of_few") - 1)).alias("i"), every.alias("j")).alias("y")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("key", "i", "j")]
    once = F.expr("x.comp != y.comp and (y.comp = y.main or x.id < y.id)")
    least = F.expr("x.key = array_min(array_intersect(x.keys, y.keys))")
    conditions = [*same, once, _near("x", "y"), *([] if marks is None else [_explained()]), least]
    met = x.join(y, conditions)
    return met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def _few_places(places: DataFrame) -> DataFrame:
    """As ``few_rows``, by the places that the rows list, as one row may list any number."""
    listed = places.agg(F.sum(F.size("places"))).first()[0] or 0
    return F.broadcast(places) if listed <= FEW else places.hint("shuffle_hash")


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the text left and two columns more: lines dropped, lines before.

    Null text stays null and has no lines; an empty text has one. A text without any dropped line
    is returned as it was. Repeated rows are rows of their own: the first keeps its lines.
    """
    stored, row = numbered(docs, "documents")
    each_line = F.split(F.lower("text"), "\n", -1)
    split_lines = stored.select(F.col(row).alias("row"), F.posexplode(each_line).alias("pos", "line"))
    worded = split_lines.select("row", "pos", _once(words_of(F.col("line"))).alias("words")).where(F.size("words") >= MIN_WORDS)
    # A step for each thing that a later one reads several times; the steps are compiled.
    hashed = worded.select(
        "row", "pos", F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(1), "words").alias("h2"), _cut_keys(F.col("words")).alias("cut"), _hashes(F.col("words")).alias("hashes")
    )
    sampled = hashed.select("*", _once(_smallest(F.col("hashes"))).alias("smallest"))
    lines = sampled.select(
        "row",
        "pos",
        "h1",
        "h2",
        F.array_compact("cut").alias("cut"),
        _sampled_keys(F.col("hashes"), F.col("smallest")).alias("sampled"),
        F.monotonically_increasing_id().alias("line_id"),
    )
    lines = cut_lineage(lines, "lines")
    unique = cut_lineage(lines.groupBy("h1", "h2").agg(F.min("line_id").alias("id"), F.count(F.lit(1)).alias("copies")), "unique")
    first = unique.select(F.col("id").alias("line_id")).hint("shuffle_hash")
    none = F.array().cast("array<bigint>")
    keys = F.concat(F.coalesce("cut", none), F.coalesce("sampled", none))
    members = lines.select("line_id", keys.alias("keys")).join(first, "line_id", "left_semi").select(F.explode("keys").alias("key"), F.col("line_id").alias("id"))
    members = cut_lineage(shared(members.where("key is not null")), "members")

    def facts_of(ids: DataFrame) -> DataFrame:
        """Words, characters, SimHash and number of words of the lines that share a bucket, in one scan."""
        places = lines.select("row", "pos", "line_id").join(ids, "line_id", "left_semi")
        places = cut_lineage(places.groupBy("row").agg(F.collect_list(F.struct("line_id", "pos")).alias("places")), "places")
        found = (
            stored.select(F.col(row).alias("row"), "text")
            .join(_few_places(places), "row")
            .select("places", _once(each_line).alias("all"))
            .select(F.explode(F.transform("places", lambda p: F.struct(p["line_id"].alias("id"), F.get("all", p["pos"]).alias("line")))).alias("p"))
            .select("p.id", _once(words_of(F.col("p.line"))).alias("words"))
        )
        found = cut_lineage(found, "found")
        n = F.size("words")
        chars = F.when(n < WHOLE_WORDS, F.array_join("words", " "))
        spelled = found.select("id", n.alias("n"), _spelled(F.col("words")).alias("line"), chars.alias("chars"))
        return spelled.join(simhashes(found), "id").select("id", "n", "sim", "line", "chars")

    facts = cut_lineage(facts_of(members.select(F.col("id").alias("line_id")).distinct()), "facts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        fact = F.struct("sim", "n", "line", "chars")
        with_a = pairs.join(facts.select(F.col("id").alias("a"), fact.alias("x")), "a")
        both = with_a.join(facts.select(F.col("id").alias("b"), fact.alias("y")), "b")
        return both.where(_near("x", "y")).where(_linked("x", "y")).select("a", "b")

    def rest(still: DataFrame) -> DataFrame:
        marks = cut_lineage(_marks(still.select("id").distinct(), facts), "marks")
        return confirmed(_met_in_blocks(_by_rare_words(still, facts), facts, marks))

    labels = link(members, confirmed, rest, few=FEW_MEMBERS)
    groups = unique.join(labels, "id", "left").withColumn("keeper", F.coalesce("comp", "id"))
    groups = groups.where((F.col("copies") > 1) | (F.col("keeper") != F.col("id"))).select("h1", "h2", "keeper")
    dropped = (
        lines.select("row", "pos", "h1", "h2", "line_id")
        .join(groups, ["h1", "h2"])
        .where("line_id != keeper")
        .groupBy(F.col("row").alias(row))
        .agg(F.collect_list("pos").alias("_gone"))
    )
    gone, count, total = free_name(docs, "_gone"), free_name(docs, "lines_dropped"), free_name(docs, "n_lines")
    joined = stored.join(dropped.withColumnRenamed("_gone", gone).hint("shuffle_hash"), row, "left")
    split = free_name(joined, "_split")
    joined = joined.withColumn(split, _once(F.split("text", "\n", -1)))
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(gone))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(F.col(split), i)), "\n"))
    return joined.select(
        *[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.coalesce(F.size(F.col(gone)), F.lit(0)).alias(count),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(split)).alias(total),
    )


def documents_without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The documents in their own columns; one goes when the dropped lines were all it said."""
    judged = drop_repeated_lines(docs)
    count = judged.columns[-2]
    emptied = (F.col(count) > 0) & ~F.col("text").rlike(r"[^ \t-\r]")
    return judged.where(~emptied).select(*[f"`{c}`" for c in docs.columns])
