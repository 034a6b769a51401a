from __future__ import annotations

import bz2
import csv
import gzip
import os

import pytest

from formweave.sources.compression import decoded_lines, list_files, readable_paths, sniff
from formweave.sources.dictionary import EmptyInputError, read_dictionary
from formweave.sources.dump import load_csv

TEXT = 'id,note\n1,"é, ""q"""\n2,\n3,"last"'


def put(folder, name, data):
    os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(data)
    return f"{folder}/{name}"


def rows(df):
    return sorted(map(tuple, df.collect()))


WANT = [("1", 'é, "q"'), ("2", None), ("3", "last")]


@pytest.mark.parametrize("name,data", [
    ("zip.csv", gzip.compress(TEXT.encode())), ("plain.csv.gz", TEXT.encode()), ("good.csv", TEXT.encode()),
    ("good.csv.gz", gzip.compress(TEXT.encode())), ("b.csv", bz2.compress(TEXT.encode())),
    ("bz.gz", bz2.compress(TEXT.encode())), ("good.bz2", bz2.compress(TEXT.encode())),
    ("two.csv", gzip.compress(TEXT[:20].encode()) + gzip.compress(TEXT[20:].encode()))])
def test_files_are_read_by_content(spark, tmp_dir, name, data):
    assert rows(load_csv(spark, put(tmp_dir, name, data))) == WANT


def test_a_folder_of_all_kinds(spark, tmp_dir):
    put(tmp_dir, "in/a.csv", gzip.compress(TEXT.encode()))
    put(tmp_dir, "in/b.csv.gz", TEXT.encode())
    put(tmp_dir, "in/c.csv", TEXT.encode())
    put(tmp_dir, "in/_SUCCESS", b"")
    found = sniff(spark, f"{tmp_dir}/in")
    assert [(os.path.basename(f.path), f.named, f.holds) for f in found] == [
        ("a.csv", "plain", "gzip"), ("b.csv.gz", "gzip", "plain"), ("c.csv", "plain", "plain")]
    assert rows(load_csv(spark, f"{tmp_dir}/in")) == sorted(WANT * 3)
    assert rows(load_csv(spark, f"{tmp_dir}/in/*.csv")) == sorted(WANT * 2)


def test_right_names_are_left_alone(spark, tmp_dir):
    put(tmp_dir, "in/a.csv.gz", gzip.compress(TEXT.encode()))
    put(tmp_dir, "in/b.csv", TEXT.encode())
    assert readable_paths(spark, f"{tmp_dir}/in") == f"{tmp_dir}/in"
    assert len(list_files(spark, [f"{tmp_dir}/in", f"{tmp_dir}/in/b*"])) == 2


def test_an_empty_file_still_raises(spark, tmp_dir):
    for name in ("empty.csv", "empty.csv.gz"):
        with pytest.raises(EmptyInputError):
            load_csv(spark, put(tmp_dir, name, b""))


def test_long_files_are_decoded_in_pieces():
    lines = [f"line {i} " + "x" * (i % 300) for i in range(40_000)]
    text = "\n".join(lines).encode()
    for codec, pack in (("gzip", gzip.compress), ("bzip2", bz2.compress), ("plain", bytes)):
        assert list(decoded_lines(memoryview(pack(text)), codec)) == lines
    with pytest.raises(EOFError):
        list(decoded_lines(memoryview(gzip.compress(text)[:-2000]), "gzip"))


def test_a_dictionary_in_files_keeps_their_order(spark, tmp_dir):
    """The smaller first file comes first, however Spark packs the files."""
    header = ["Variable / Field Name", "Form Name", "Section Header", "Field Type"]
    sizes = [3, 400, 1, 50]
    n, want = 0, []
    for i, size in enumerate(sizes):
        with open(f"{tmp_dir}/{i}.csv", "w", newline="") as f:
            w = csv.writer(f)
            w.writerow(header)
            for j in range(size):
                head = f"Section\n{n}" if n % 60 == 1 else ""
                want.append((n, f"f{n}", f"Section\n{(n - 1) // 60 * 60 + 1}" if n else None))
                w.writerow([f"f{n}", "form", head, "text"])
                n += 1
    got = read_dictionary(spark, tmp_dir).orderBy("ord").select("ord", "field", "hdr").collect()
    assert [tuple(r) for r in got] == want
