import random
import re

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import lines, linking


def norm(line):
    return " ".join(re.sub(r"[\x00-@\[-`{-\x7f]+", " ", line.lower()).split(" ")).strip()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def by_force(spark, texts):
    """Rows of the places that stay, by comparing every pair of lines."""
    places = [(i, k, norm(x)) for i, t in enumerate(texts) if t is not None for k, x in enumerate(t.split("\n"))]
    places = [p for p in places if len(p[2].split(" ")) >= lines.MIN_WORDS]
    unique = list(dict.fromkeys(p[2] for p in places))
    sims = [
        r[0] & (2**64 - 1)
        for r in spark.createDataFrame([(i, u) for i, u in enumerate(unique)], "i long, u string")
        .transform(lambda df: lines.with_simhash(df, F.split("u", " ")))
        .orderBy("i")
        .select("sim")
        .collect()
    ]
    root = list(range(len(unique)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(unique)):
        for j in range(i):
            x, y = unique[i].split(" "), unique[j].split(" ")
            if len(x) == len(y) < 10:
                one = sum(a != b for a, b in zip(x, y)) == 1
                near = one and distance(unique[i], unique[j]) <= max(len(unique[i]), len(unique[j])) // 10
            else:
                near = (sims[i] ^ sims[j]).bit_count() <= lines.DISTANCE and distance(x, y) <= max(len(x), len(y)) // 10
            if near:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    group = {u: find(i) for i, u in enumerate(unique)}
    seen, gone = set(), set()
    for i, k, u in places:
        if group[u] in seen:
            gone.add((i, k))
        seen.add(group[u])
    return [None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in enumerate(texts)]


def test_simhash_is_the_majority_of_hash_bits(spark):
    texts = ["a b c", "x", "q w e r t y " * 30, " ".join(f"w{i}" for i in range(40_000))]
    frame = spark.createDataFrame([(i, t.strip()) for i, t in enumerate(texts)], "i long, t string")
    got = [r.sim for r in lines.with_simhash(frame, F.split("t", " ")).orderBy("i").collect()]
    words = frame.select("i", F.explode(F.split("t", " ")).alias("w")).select("i", F.xxhash64("w").alias("h")).collect()
    for i, sim in enumerate(got):
        hashes = [r.h for r in words if r.i == i]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert sim & (2**64 - 1) == want


def test_equal_to_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"{a}{b}word" for a in "abcdefgh" for b in "klmnopqr"]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 40))) for _ in range(12)]
    texts = [None, "", "\n\n", "one two", "one two\none two"]
    for _ in range(30):
        some = []
        for _ in range(rng.randint(1, 5)):
            words = rng.choice(base).split(" ")
            for _ in range(rng.choice((0, 0, 1, 1, 2))):
                at = rng.randrange(len(words))
                words[at] = words[at][:-1] + rng.choice("xyz")
            some.append(" ".join(words).capitalize() + rng.choice([".", "", "!!", " 12"]))
        texts.append("\n".join(some))
    texts.append(" ".join(vocabulary * 500) + "\n" + base[0])
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.text for r in lines.drop_repeated_lines(docs).collect()}
    short = [t if t is None or len(t) < 10_000 else t for t in texts]
    assert [got[i] for i in range(len(texts))] == by_force(spark, short[:-1]) + [texts[-1].split("\n")[0]]


def test_documents_go_only_when_nothing_is_left(spark):
    line = "alpha beta gamma delta epsilon zeta."
    rows = [(1, line, "s"), (2, line, "s"), (3, line + "\nok", "s"), (4, None, "s"), (5, "", "s"), (6, line + "\n \n", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lines_dropped string").coalesce(1)
    out = lines.documents_without_repeated_lines(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: line, 3: "ok", 4: None, 5: ""}


@pytest.mark.parametrize("n", [0, 3])
def test_repeated_rows_and_empty_tables(spark, n):
    docs = spark.createDataFrame([(None, "alpha beta gamma delta epsilon", 1)] * n, "doc_id long, text string, _row int")
    out = lines.drop_repeated_lines(docs).collect()
    assert len(out) == n and sum(r.lines_dropped for r in out) == max(0, n - 1)


def test_near_lines_meet_whatever_their_hashes(spark):
    """Pairs at the edit limit, without the gate of the SimHash: nearly all are linked."""
    rng = random.Random(8)
    pairs = []
    for n in [10, 10, 12, 15, 19, 20, 25, 29, 30, 35, 39, 40, 50, 60, 80, 99, 100, 130, 200, 400] * 15:
        x = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
        y = list(x)
        for at in rng.sample(range(n), n // 10):
            y[at] = rng.choice([y[at] + "x", "other" + y[at], "the"])
        if rng.random() < 0.5:  # a word left out instead of one edited
            at = next(i for i in range(n) if x[i] != y[i])
            del y[at]
        assert 0 < distance(x, y) <= n // 10
        pairs.append(" ".join(x) + "\n" + " ".join(y))
    docs = spark.createDataFrame(list(enumerate(pairs)), "doc_id long, text string")
    out = lines.drop_repeated_lines(docs).collect()
    assert sum(r.lines_dropped for r in out) >= 0.99 * len(pairs)
    assert all(r.text == pairs[r.doc_id].split("\n")[0] for r in out if r.lines_dropped)


@pytest.mark.parametrize("n", [3, 500_001])
def test_only_few_places_are_broadcast(spark, n):
    places = spark.range(1).select(F.col("id").alias("row"), F.sequence(F.lit(1), F.lit(n)).alias("places"))
    plan = spark.range(5).select(F.col("id").alias("row")).join(lines._few_places(places), "row")
    assert ("strategy=broadcast" in plan._jdf.queryExecution().analyzed().toString()) == (n == 3)


def test_short_lines_may_have_one_typo(spark):
    kept = "shipping to most of europe takes seven days"
    rows = [kept, "Shipping to most of Europe takes sevan days!", "shipping to most of africa takes seven days", "shiping to most of europe takes sevan days"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").coalesce(1)
    out = {r.doc_id: r.lines_dropped for r in lines.drop_repeated_lines(docs).collect()}
    # The last line is two words away from the first, but one from the second.
    assert out == {0: 0, 1: 1, 2: 0, 3: 1}


def test_blocks_meet_after_any_edits(spark):
    """Every pair of lines up to the sampled lengths shares a key after as many edits as the rule allows."""
    rng = random.Random(9)
    rows = []
    for n in list(range(9, 40)) * 12:
        x = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        y = list(x)
        longest = n * 10 // 9
        for _ in range(longest // 10):
            at, kind = rng.randrange(len(y)), rng.random()
            if kind < 0.4:
                y[at] = "other"
            elif kind < 0.7:
                del y[at]
            else:
                y.insert(at, "more")
        if distance(x, y) <= max(len(x), len(y)) // 10:
            rows.append((x, y))
    frame = spark.createDataFrame(rows, "x array<string>, y array<string>")
    apart = frame.where(~F.arrays_overlap(lines.block_keys(F.col("x")), lines.block_keys(F.col("y"))))
    assert len(rows) > 200 and [] == [(len(r.x), len(r.y)) for r in apart.collect() if not (len(r.x) == len(r.y) == 9)]


def test_open_buckets_are_compared_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(lines, "BLOCK", 3)
    rng = random.Random(4)
    comp = {i: rng.randrange(8) for i in range(40)}
    still = spark.createDataFrame([(1, i, c) for i, c in comp.items()] + [(2, i, comp[i]) for i in range(5)], "key long, id long, comp long")
    facts = spark.createDataFrame([(i, 12, 7) for i in comp], "id long, n int, sim long")
    got = {tuple(sorted(p)) for p in lines._met_in_blocks(still, facts).collect()}
    assert got == {(i, j) for i in comp for j in comp if i < j and comp[i] != comp[j]}


def test_a_long_text_with_one_repeated_line(spark):
    many = [f"short {i}" for i in range(60_000)]
    line = "alpha beta gamma delta epsilon zeta"
    docs = spark.createDataFrame([(0, "\n".join([line, *many, line, "end"]))], "doc_id long, text string")
    (row,) = lines.drop_repeated_lines(docs).collect()
    assert row.text == "\n".join([line, *many, "end"]) and row.n_lines == 60_003


def test_lines_with_a_common_passage_are_not_all_compared(spark):
    """A large open bucket gives the pairs that the rule may link and few others."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(5000)]
    passage = words[:20]
    texts = []
    for _ in range(300):
        n = rng.randint(15, 90)
        own = rng.sample(words, n)
        at = rng.randrange(n)
        texts.append(own[:at] + passage + own[at:])
    for x in texts[:60]:
        y = list(x)
        for at in rng.sample(range(len(y)), len(y) // 10):
            y[at] = rng.choice(["other", "the", y[0]])
        if rng.random() < 0.5:
            at = next(i for i in range(len(y)) if y[i] != x[i])
            del y[at]
        texts.append(y)
    near = {(i, 300 + i) for i in range(60)}
    assert all(distance(texts[i], texts[j]) <= max(len(texts[i]), len(texts[j])) // 10 for i, j in near)
    said = F.col("words")
    facts = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, words array<string>")
    facts = facts.select("id", F.size(said).alias("n"), F.lit(7).cast("long").alias("sim"), lines._spelled(said).alias("line"))
    still = spark.createDataFrame([(k, i, i) for k in (1, 2) for i in range(len(texts))], "key long, id long, comp long")
    marks = lines._marks(still.select("id").distinct(), facts)
    met = [tuple(sorted(p)) for p in lines._met_in_blocks(lines._by_rare_words(still, facts), facts, marks).collect()]
    assert near <= set(met) and len(met) == len(set(met)) < 2 * len(texts)
    # Neither step alone loses a pair.
    for some in (lines._met_in_blocks(lines._by_rare_words(still, facts), facts), lines._met_in_blocks(still, facts, marks)):
        assert near <= {tuple(sorted(p)) for p in some.collect()}


def test_rare_words_and_marks_lose_no_pair_within_the_rule(spark):
    """Lines from nine words on, with few different words or many, that differ as much as the rule allows."""
    rng = random.Random(12)
    texts = []
    for n in list(range(9, 60)) * 3 + [200, 500]:
        x = [f"w{rng.randrange(rng.choice((3, 30, 3000)))}" for _ in range(n)]
        y = list(x)
        for _ in range(rng.choice((n // 10, n // 9)) or 1):
            at, kind = rng.randrange(len(y)), rng.random()
            if kind < 0.4:
                y[at] = f"w{rng.randrange(40)}"
            elif kind < 0.7:
                del y[at]
            else:
                y.insert(at, "w1")
        texts += [x, y]
    near = {(i, i + 1) for i in range(0, len(texts), 2) if distance(texts[i], texts[i + 1]) <= max(len(texts[i]), len(texts[i + 1])) // 10}
    near |= {(i, i + 1) for i in range(0, len(texts), 2) if len(texts[i]) == len(texts[i + 1]) == 9 and distance(texts[i], texts[i + 1]) == 1}
    assert len(near) > 100
    said = F.col("words")
    facts = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, words array<string>")
    facts = facts.select("id", F.size(said).alias("n"), F.lit(7).cast("long").alias("sim"), lines._spelled(said).alias("line"))
    still = spark.createDataFrame([(1, i, i) for i in range(len(texts))], "key long, id long, comp long")
    marks = lines._marks(still.select("id").distinct(), facts)
    met = {tuple(sorted(p)) for p in lines._met_in_blocks(lines._by_rare_words(still, facts), facts, marks).collect()}
    assert near <= met


def test_only_the_rarest_words_of_a_line_become_rows(spark):
    """A large bucket is dealt by n / 10 + 1 words of each line, those that fewest lines have."""
    rng = random.Random(13)
    words = [f"w{i}" for i in range(40_000)]
    texts = [words[:20] + rng.sample(words[20:], 40) for _ in range(200)]
    said = F.col("words")
    facts = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, words array<string>")
    facts = facts.select("id", F.size(said).alias("n"), lines._spelled(said).alias("line"))
    still = spark.createDataFrame([(k, i, i) for k in (1, 2) for i in range(len(texts))], "key long, id long, comp long")
    made = []
    keep = lines.cut_lineage

    def kept(df, name):
        made.append((name, out := keep(df, name)))
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(lines, "cut_lineage", kept)
        dealt = lines._by_rare_words(still, facts)
    assert "times" not in "".join(",".join(df.columns) for _, df in made)  # no row for each time of each word
    assert dict(made)["dealt"].count() == 7 * len(texts)
    assert dealt.groupBy("key").count().agg(F.max("count")).first()[0] < 20


def test_few_members_go_to_the_rest_after_the_first_round(spark):
    """Small open buckets are compared in full at once; large ones get further leaders first."""
    members = spark.createDataFrame([(1, i) for i in range(4)] + [(2, i) for i in range(10, 30)], "key long, id long")
    met, left = [], []

    def verify(pairs):
        met.append({x for r in pairs.collect() for x in r})
        return pairs.where(F.col("a") % 5 == F.col("b") % 5)

    def rest(still):
        left.append({(r.key, r.id) for r in still.collect()})
        x, y = still.alias("x"), still.alias("y")
        return x.join(y, F.expr("x.key = y.key and x.id < y.id and x.id % 5 = y.id % 5")).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))

    labels = {r.id: r.comp for r in linking.link(members, verify, rest, few=10).collect()}
    assert labels == {i: 10 + i % 5 for i in range(10, 30)}
    assert all(min(m) >= 10 for m in met[1:]) and len(met) == 3 and {(1, i) for i in range(4)} <= left[0]
    whole = {r.id: r.comp for r in linking.link(members, verify, rest).collect()}
    assert whole == labels


def test_keys_and_simhashes_are_compiled(spark):
    """No higher-order function is around the work of each word, so Spark compiles it."""
    stored = spark.createDataFrame([(0, ["a"] * 50, [7] * 50, [7])], "id long, words array<string>, hashes array<long>, smallest array<long>")
    steps = [
        stored.select(lines._cut_keys(F.col("words"))),
        stored.select(lines._sampled_keys(F.col("hashes"), F.col("smallest"))),
        lines.simhashes(stored),
    ]
    assert not any("lambda" in s._jdf.queryExecution().optimizedPlan().toString() for s in steps)


def test_simhashes_of_lines_of_any_length(spark):
    rng = random.Random(14)
    texts = [[f"w{rng.randrange(60)}" for _ in range(n)] for n in (1, 2, 64, 127, 128, 254, 255, 256, 700, 20_000)] + [["one"] * 300]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, words array<string>")
    got = {r.id: r.sim for r in lines.simhashes(frame).collect()}
    hashes = {r.w: r.h for r in spark.createDataFrame([(w,) for w in {w for t in texts for w in t}], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    for i, words in enumerate(texts):
        assert got[i] & (2**64 - 1) == sum(1 << b for b in range(64) if 2 * sum(hashes[w] >> b & 1 for w in words) > len(words))


def test_every_line_has_keys_and_none_for_places_outside(spark):
    frame = spark.createDataFrame([(n, [f"w{i}" for i in range(n)]) for n in range(5, 60)], "n int, words array<string>")
    rows = frame.select("n", lines.block_keys(F.col("words")).alias("keys")).collect()
    assert all(r["keys"] and None not in r["keys"] and len(set(r["keys"])) == len(r["keys"]) for r in rows)
    assert all(0 <= at <= at + m <= n and m > 0 for n in range(10, 40) for b in lines._blocks(n) for at, m in [(b >> 6 & 63, b & 63)])


def test_a_member_met_twice_is_no_company(spark):
    members = spark.createDataFrame([(1, 5), (1, 5), (2, 6), (2, 7), (2, 7), (3, 8)], "key long, id long")
    assert sorted(tuple(r) for r in linking.shared(members).collect()) == [(2, 6), (2, 7), (2, 7)]
