"""SRC-03: records over several lines, against the public CSV reader, also over split boundaries."""
import io
import os
import random

import pandas as pd
import pytest

from itemtrack.operators.common import materialize
from itemtrack.sources import tsv

COLUMNS = ["a", "b", "c"]


@pytest.fixture()
def tiny_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "40")
    spark.conf.set(names[1], "1")
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def random_file(rng, rows):
    """A file whose quoted fields are all closed."""
    def field():
        kind = rng.randint(0, 5)
        if kind == 0:
            body = "".join(rng.choice(['x', '""', '\t', '\n', '\n\n', ' ', 'NA']) for _ in range(rng.randint(0, 12)))
            return f'"{body}"' + rng.choice(["", "", "t", 't"u'])
        return rng.choice(["", "NA", "12", "a b", 'in"ner', "long text without any quotes"])

    lines = ["c\ta\tb"] if rng.random() < .8 else ['"c"\ta\t"b"']
    for n in range(rows):
        # A first row wider than the header would give that reader an unnamed index column.
        width = rng.choice([1, 2, 3, 3, 3, 3, 4]) if n else 3
        lines.append("\t".join([rng.choice(["k", '"k\nk"']), *[field() for _ in range(width - 1)]]))
        lines += [""] * (rng.random() < .1)
    return "\n".join(lines) + "\n" * rng.randint(0, 2)


def expected(text):
    frame = pd.read_csv(io.StringIO(text), sep="\t", dtype=str, on_bad_lines="skip", engine="c")
    return [tuple(None if pd.isna(v) else v for v in r) for r in frame[COLUMNS].values.tolist()]


def read(spark, path):
    rows = tsv.read_tolerant_tsv(spark, path, COLUMNS).orderBy("seq").collect()
    out = {}
    for r in rows:
        out.setdefault(os.path.basename(r["_file"]), []).append(tuple(r[c] for c in COLUMNS))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_the_public_reader(spark, tmp_dir, tiny_splits, seed):
    rng = random.Random(seed)
    want = {}
    for n in range(4):
        text = random_file(rng, rng.randint(0, 25))
        with open(f"{tmp_dir}/f{n}.txt", "w") as fh:
            fh.write(text)
        rows = expected(text)
        if rows:
            want[f"f{n}.txt"] = rows
    assert read(spark, tmp_dir) == want


def test_a_field_over_many_splits(spark, tmp_dir, tiny_splits):
    body = "\n".join(f"line {i} of a long field" for i in range(60))
    text = f'a\tb\tc\n1\t"{body}"\tend\n2\t"x\ny"\tz\n3\tq\t"r\n\ns"\n'
    with open(f"{tmp_dir}/f.txt", "w") as fh:
        fh.write(text)
    assert read(spark, tmp_dir) == {"f.txt": [("1", body, "end"), ("2", "x\ny", "z"), ("3", "q", "r\n\ns")]}


def test_an_unclosed_quote_opens_nothing(spark, tmp_dir):
    with open(f"{tmp_dir}/f.txt", "w") as fh:
        fh.write('a\tb\tc\n1\t"ok\nok"\t2\n3\t"never closed\t4\n5\t6\t7\n')
    assert [r[0] for r in read(spark, tmp_dir)["f.txt"]] == ["1", "3", "5"]


def test_lines_are_not_exchanged(spark, tmp_dir):
    """The rows come from one scan of the files, joined to written tables of places and headers."""
    with open(f"{tmp_dir}/f.txt", "w") as fh:
        fh.write('a\tb\tc\n' + '1\t"two\nlines"\t3\n4\t5\t6\n' * 50)
    plain = materialize(tsv.read_tolerant_tsv(spark, tmp_dir, COLUMNS))
    assert plain.count() == 100
    with open(f"{tmp_dir}/f.txt", "w") as fh:
        fh.write('a\tb\tc\n' + '1\t"quoted"\t3\n4\t5\t6\n' * 50)
    plan = tsv.read_tolerant_tsv(spark, tmp_dir, COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan text") == 1
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and all("BroadcastExchange" in line for line in exchanges)
