"""Random files, written by Python's own csv module, must come back as that module reads them."""

import csv
import io
import random

import pytest
from pyspark.errors import PySparkException

from washline.sources import read_csv_table

PIECES = ["\n", "\r\n", '"', '""', ",", " ", "\\", "\t", "a", "b c", "7", "-", "'", ";", "#"]


def random_rows(rng, width, count, pieces):
    def cell():
        return "".join(rng.choices(pieces, k=rng.choice([0, 1, 1, 2, 3, 6])))

    rows = [[str(i)] + [cell() for _ in range(width - 1)] for i in range(count)]
    return [row if any(row) else ["x"] * width for row in rows]


def as_csv(rows, width, line_end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=line_end)
    writer.writerow([f"c{i}" for i in range(width)])
    writer.writerows(rows)
    return out.getvalue()


def found(df):
    return sorted([["" if v is None else v for v in row] for row in df.collect()])


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(4))
def test_multiline_read_equals_csv_module(spark, csv_file, seed, line_end):
    rng = random.Random(seed)
    width = rng.randint(2, 6)
    rows = random_rows(rng, width, 400, [*PIECES, "\r"])
    path = csv_file(as_csv(rows, width, line_end))
    df = read_csv_table(spark, path, typed=False, na_tokens=(), multiline=True)
    assert found(df) == sorted(rows)


@pytest.mark.parametrize("seed", range(6))
def test_split_read_equals_csv_module(spark, csv_file, seed):
    rng = random.Random(100 + seed)
    width = rng.randint(1, 6)
    rows = random_rows(rng, width, 400, [p for p in PIECES if "\n" not in p])
    df = read_csv_table(spark, csv_file(as_csv(rows, width)), typed=False, na_tokens=())
    assert found(df) == sorted(rows)


@pytest.mark.parametrize("seed", range(12))
def test_split_read_refuses_every_line_break(spark, csv_file, seed):
    rng = random.Random(200 + seed)
    width = rng.randint(2, 4)
    rows = random_rows(rng, width, 50, [p for p in PIECES if "\n" not in p])
    place = rng.randrange(1, width)
    rows[rng.randrange(50)][place] = rng.choice(["x\ny", "\n", 'p,"\nq,r', "u\n\nv,w", '"\n"'])
    df = read_csv_table(spark, csv_file(as_csv(rows, width)), typed=False, na_tokens=())
    with pytest.raises(PySparkException, match="line break inside quotes"):
        df.collect()


@pytest.mark.parametrize("seed", range(12))
def test_surplus_fields_are_never_dropped(spark, csv_file, seed):
    rng = random.Random(300 + seed)
    width = rng.randint(1, 5)
    rows = random_rows(rng, width, 50, [p for p in PIECES if "\n" not in p])
    surplus = [rng.choice(["", "z", "a,b", '"']) for _ in range(rng.randint(1, 3))]
    rows[rng.randrange(50)].extend(surplus)
    for multiline in (False, True):
        path = csv_file(as_csv(rows, width))
        df = read_csv_table(spark, path, typed=False, na_tokens=(), multiline=multiline)
        with pytest.raises(PySparkException, match=f"more than {width} fields"):
            df.collect()


def test_short_rows_end_in_nulls(spark, csv_file):
    rng = random.Random(9)
    rows = random_rows(rng, 4, 200, [p for p in PIECES if "\n" not in p])
    short = [row[: rng.randint(1, 4)] for row in rows]
    df = read_csv_table(spark, csv_file(as_csv(short, 4)), typed=False, na_tokens=())
    assert found(df) == sorted(row + [""] * (4 - len(row)) for row in short)
