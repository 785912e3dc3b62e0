"""The multi-line reader against Python's csv module, with splits of a few bytes."""

import csv
import random
from collections import Counter

import pytest

from tallyhouse.sources import raw
from tallyhouse.sources.multiline import read_split_csv
from tallyhouse.sources.schemas import RAW_SCHEMAS

NAME = "raw_order_reviews"
COLUMNS = RAW_SCHEMAS[NAME].fieldNames()


@pytest.fixture(params=[40, 300, 100000])
def small_splits(spark, request):
    keys = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _field(rng):
    pieces = ["word", " ", "\n", "\r\n", '"', ",", "\n\n", "é", "'", '""', "x" * 30]
    text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 8)))
    if any(c in text for c in '"\n\r,') or rng.random() < 0.3:
        return '"' + text.replace('"', '""') + '"'
    return text.strip()


def _write(folder, newline, files=3, rows=120, seed=1):
    rng = random.Random(seed)
    for i in range(files):
        body = [",".join(COLUMNS)]
        for r in range(rows if i else 0):  # the first file has a header only
            body.append(",".join([f"{i}-{r}", "o", *[_field(rng) for _ in COLUMNS[2:]]]))
        (folder / f"{i}.csv").write_bytes((newline.join(body) + newline).encode())


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_same_rows_as_csv_module(spark, tmp_path, small_splits, newline):
    _write(tmp_path, newline)
    want = Counter()
    for file in tmp_path.glob("*.csv"):
        with file.open(newline="", encoding="utf-8") as f:
            want.update(tuple(row) for row in list(csv.reader(f))[1:])
    assert sum(want.values()) == 240
    assert Counter(map(tuple, raw.load_raw(spark, NAME, str(tmp_path)).collect())) == want


def test_record_longer_than_several_splits(spark, tmp_path, small_splits):
    text = "\n".join(f'line {i} ""q""' for i in range(200))
    (tmp_path / "a.csv").write_text(",".join(COLUMNS) + f'\n1,o,5,t,"{text}",a,b\n2,o,5,t,"z",a,b')
    rows = raw.load_raw(spark, NAME, str(tmp_path)).orderBy("review_id").collect()
    assert [r["review_id"] for r in rows] == ["1", "2"]
    assert rows[0]["review_comment_message"] == text.replace('""', '"')


def test_header_is_checked(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(reversed(COLUMNS)) + "\n1,o,5,t,m,a,b\n")
    with pytest.raises(Exception, match="header does not conform"):
        raw.load_raw(spark, NAME, str(tmp_path)).collect()


def test_short_record_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(COLUMNS) + "\n1,o,5\n")
    with pytest.raises(Exception, match="MALFORMED"):
        raw.load_raw(spark, NAME, str(tmp_path)).collect()


def test_stray_quote_fails_with_the_file(spark, tmp_path):
    """One quote that is never closed would swallow the rest of its file, also where rows are only counted."""
    names = list(RAW_SCHEMAS["raw_order_reviews"].fieldNames())
    good = ",".join(names) + "\n" + "".join(f"r{i},o,5,t,m,d,a\n" for i in range(50))
    (tmp_path / "good.csv").write_text(good)
    rows = read_split_csv(spark, str(tmp_path / "good.csv"), RAW_SCHEMAS["raw_order_reviews"])
    assert rows.count() == 50
    (tmp_path / "bad.csv").write_text(good.replace("r7,o,5,t,m", 'r7,o,5,"t,m'))
    rows = read_split_csv(spark, str(tmp_path / "bad.csv"), RAW_SCHEMAS["raw_order_reviews"])
    for action in (rows.count, rows.collect):
        with pytest.raises(Exception, match="bad.csv"):
            action()
