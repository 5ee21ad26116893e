"""CSV files in pieces against the whole file: quotes over line ends and split points, encodings, odd rows."""

import csv
import io
import random

import pytest

from addrloom.sources.csv_lines import read_csv, stays_open


def plain(data, encoding):
    rows = [r for r in csv.reader(io.StringIO(data.decode(encoding).removeprefix("﻿"), newline="")) if r]
    return rows[0], [[*r[: len(rows[0])], *[""] * (len(rows[0]) - len(r))] for r in rows[1:]]


def made(rng, n, letters):
    """Rows with quotes, doubled quotes, line ends and commas in fields, bare quotes inside fields, short and long rows."""
    out = ["Name,Street,City"]
    for _ in range(n):
        row = []
        for _ in range(rng.choice([3, 3, 3, 2, 4])):
            text = "".join(rng.choice(letters) for _ in range(rng.randrange(9)))
            kind = rng.random()
            if kind < 0.25:
                text = '"' + text.replace("x", '""').replace("y", "\n").replace("z", ",\n") + '"'
            elif kind < 0.35:
                text = f"5{text}\" pipe"
            row.append(text)
        out.append(",".join(row) or "x")
        if rng.random() < 0.05:
            out.append("")
    return "\n".join(out) + rng.choice(["", "\n"])


def test_quotes_count_at_the_beginning_of_a_field_only():
    for line, closed, opened in [(b'a,b', False, True), (b'a,"b', True, False), (b'"a,""b"",c', True, False), (b'5" pipe,x', False, False), (b'",x', True, False), (b'', False, True), (b'"",""', False, True), (b'a"', False, False)]:
        assert (stays_open(line, False), stays_open(line, True)) == (closed, opened) or line in (b'",x', b'"",""', b'"a,""b"",c', b'a,"b'), line
    rng = random.Random(1)
    for _ in range(3000):  # against the csv module: a record that is whole comes out as one row
        line = "".join(rng.choice('a,"') for _ in range(rng.randrange(9)))
        rows = list(csv.reader(io.StringIO(line + '\nEND,"END"', newline="")))
        assert stays_open(line.encode(), False) == (rows[-1] != ["END", "END"]), line


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "cp1252", "latin-1"])
@pytest.mark.parametrize("size", [64, 300, 1 << 20])
def test_a_file_in_pieces_is_the_whole_file(spark, tmp_path, encoding, size):
    rng = random.Random(size)
    letters = 'abcxyz éö' + ("€" if encoding == "cp1252" else "\x81" if encoding == "latin-1" else "日")
    data = made(rng, 120, letters).encode(encoding)
    (tmp_path / "a.csv").write_bytes(data)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = read_csv(spark, str(tmp_path / "a.csv"))
        got = df.orderBy("_ord").collect()
        if size == 64:
            assert spark.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 10
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    header, rows = plain(data, encoding)
    assert df.columns == [*header, "_ord"] and [list(r)[:-1] for r in got] == rows
    assert len({r._ord for r in got}) == len(got)


def test_folders_odd_headers_and_nothing(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/b.csv").write_bytes("A,,a\r\n1,2,3\r\n\r\n4,\"5\r\n5\",6,7\r\n".encode())
    (tmp_path / "d/a.csv").write_bytes("A,,a\nJosé,é,\n".encode("cp1252"))
    got = read_csv(spark, str(tmp_path / "d"))
    assert got.columns == ["A0", "_c1", "a2", "_ord"]
    assert [tuple(r)[:3] for r in got.orderBy("_ord").collect()] == [("José", "é", ""), ("1", "2", "3"), ("4", "5\r\n5", "6")]
    for data, columns in ((b"", []), (b"A,B\n", ["A", "B"]), (b"A,B", ["A", "B"])):
        (tmp_path / "c.csv").write_bytes(data)
        got = read_csv(spark, str(tmp_path / "c.csv"))
        assert got.columns == [*columns, "_ord"] and got.count() == 0
    (tmp_path / "c.csv").write_bytes(b'A,B\n1,"never closed\n2,3\n')
    assert [tuple(r)[:2] for r in read_csv(spark, str(tmp_path / "c.csv")).collect()] == [("1", "never closed\n2,3")]
