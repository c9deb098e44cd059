"""Readers and writers on files with the defects real files have."""

import glob
import gzip

import pytest
from data import edges, links, table

from edgeworks import sources
from edgeworks.operators import matrix


@pytest.fixture
def text(tmp_path):
    def write(*lines):
        path = tmp_path / "lines.txt"
        path.write_text("".join(line + "\n" for line in lines))
        return str(path)

    return write


def test_space_edges_keep_only_lines_of_two_fields(spark, text):
    path = text("1 2", "# from to", "3", "", "4 5 6", "1 2", "2 1", "7 7", "8 ", "9  10")
    assert table(sources.read_edge_list(spark, path)) == [("1", "2"), ("1", "2"), ("2", "1"), ("7", "7"), ("8", "")]


def test_tab_edges(spark, text):
    path = text("# Nodes: 3", "# FromNodeId\tToNodeId\tx", "0\t1", "1\t2", "1 2")
    assert table(sources.read_edge_list(spark, path, sep="\t")) == [("0", "1"), ("1", "2")]


def test_integer_edges(spark, text):
    good = text(" 1\t2 ", "3   4")
    read = sources.read_edge_list(spark, good, sep=r"\s+", id_type="bigint", on_bad="fail", attr=1)
    assert table(read) == [(1, 2, 1), (3, 4, 1)]
    assert read.dtypes == [("src", "bigint"), ("dst", "bigint"), ("attr", "int")]


@pytest.mark.parametrize("bad", ["1", "1 x", "1 2 3", ""])
def test_a_bad_line_fails_the_job_when_asked(spark, text, bad):
    path = text("1 2", bad)
    strict = sources.read_edge_list(spark, path, sep=r"\s+", id_type="bigint", on_bad="fail")
    with pytest.raises(Exception, match="bad edge line"):
        strict.collect()
    loose = sources.read_edge_list(spark, path, sep=r"\s+", id_type="bigint")
    assert table(loose) == [(1, 2)]


def test_empty_file(spark, text):
    assert table(sources.read_edge_list(spark, text())) == []


def test_scored_links(spark, text):
    path = text("protein1 protein2 combined_score", "a b 200", "b c 150")
    assert table(sources.read_scored_links(spark, path)) == [("a", "b", 200), ("b", "c", 150)]
    assert table(sources.read_scored_links(spark, path, min_score=200)) == [("a", "b", 200)]
    assert sources.read_scored_links(spark, path, score_type="double").dtypes[2] == ("score", "double")


def test_scored_links_with_bad_rows(spark, text):
    path = text("protein1 protein2 combined_score", "a b 1", "a b", "a b many", "a b 2 3", "c d 4")
    assert table(sources.read_scored_links(spark, path, on_bad="drop")) == [("a", "b", 1), ("c", "d", 4)]
    with pytest.raises(Exception, match="bad link line"):
        sources.read_scored_links(spark, path).collect()


def test_unscored_links_do_not_read_the_score(spark, text):
    path = text("protein1 protein2 combined_score", "a b 200")
    only = sources.read_scored_links(spark, path, on_bad="drop").select("src", "dst")
    assert table(only) == [("a", "b")]


def test_mtx(spark, text):
    path = text("%%MatrixMarket matrix coordinate pattern symmetric", "% note", "4 4 3", "2 1", "1 3", "4 4", "1 2")
    assert table(sources.read_mtx_edges(spark, path)) == [(1, 2), (1, 3)]
    assert table(sources.read_mtx_edges(spark, path, orientation="upper")) == [(1, 2), (1, 3)]
    with pytest.raises(ValueError):
        sources.read_mtx_edges(spark, path, orientation="lower")


def test_edges_as_text(spark, path):
    e = edges(spark, [(1, 2), (None, 3)], "int")
    sources.write_edges(e, path)
    assert table(sources.read_lines(spark, path)) == [("1,2",)]
    with pytest.raises(Exception, match="(?i)already exists"):
        sources.write_edges(e, path)
    sources.write_edges(e, path, sep=" ", mode="overwrite")
    assert table(sources.read_lines(spark, path)) == [("1 2",)]
    assert table(sources.count_rows(spark, path)) == [(1,)]


def test_gzip_and_number_of_files(spark, path):
    e = edges(spark, [(i, i + 1) for i in range(100)])
    sources.write_edges(e, path, compression="gzip", files=3)
    files = glob.glob(f"{path}/part-*.gz")
    assert len(files) == 3
    lines = [line for f in files for line in gzip.open(f, "rt").read().splitlines()]
    assert sorted(lines) == sorted(f"{i},{i + 1}" for i in range(100))


def test_nothing_is_written_for_an_empty_result(spark, path):
    assert sources.write_edges(edges(spark, []), path, skip_empty=True) is False
    assert glob.glob(path) == []
    assert sources.write_csv(links(spark, []), path, skip_empty=True) is False
    assert sources.write_edges(edges(spark, [(1, 2)]), path, skip_empty=True) is True


def test_matrix_files(spark, path):
    m = spark.createDataFrame([(1, [3.0, 4.5]), (0, [1.0, 2.0])], "index bigint, vector array<double>")
    sources.write_matrix_csv(m, path)
    assert table(sources.read_matrix_csv(spark, path)) == [(0, [1.0, 2.0]), (1, [3.0, 4.5])]
    grown = sources.append_rows(spark, path, matrix.head_rows(m, 1))
    assert table(grown) == [(0, [1.0, 2.0]), (1, [3.0, 4.5]), (2, [1.0, 2.0])]
    assert table(sources.table_shape(spark, path)) == [(3, 2)]
    assert table(sources.table_shape(spark, path + "-missing")) == [(0, 0)]


def test_shape_of_a_file_that_is_no_matrix(spark, path, tmp_path):
    m = spark.createDataFrame([(0, [1.0, 2.0])], "index bigint, vector array<double>")
    sources.write_parquet(m, path)
    assert table(sources.table_shape(spark, path, sources.read_matrix_parquet)) == [(1, 2)]
    # One bad file among good ones, and a bad file alone.
    for folder in (path, str(tmp_path)):
        with open(f"{folder}/part-z.parquet", "wb") as bad:
            bad.write(b"no parquet at all" * 10)
        assert table(sources.table_shape(spark, f"{folder}/*.parquet", sources.read_matrix_parquet)) == [(0, 0)]


def test_integer_matrix_as_csv(spark, path):
    m = spark.createDataFrame([(0, [1, 99])], "index bigint, vector array<bigint>")
    sources.write_matrix_csv(m, path)
    assert any("[1, 99]" in open(part).read() for part in glob.glob(f"{path}/part-*.csv"))
    assert table(sources.read_matrix_csv(spark, path)) == [(0, [1.0, 99.0])]


def test_generators(spark):
    made = sources.random_edges(spark, 300, max_id=10, partitions=3, seed=1)
    assert table(made) == table(sources.random_edges(spark, 300, max_id=10, partitions=7, seed=1))
    assert {int(v) for row in made.collect() for v in row} == set(range(1, 11))
    cells = [c for row in sources.random_matrix(spark, 20, 10).collect() for c in row["vector"]]
    assert all(0 <= c < 1 for c in cells) and len(set(cells)) == 200
    whole = [c for row in sources.random_matrix(spark, 20, 10, scale=100).collect() for c in row["vector"]]
    assert whole == [int(c * 100) for c in cells]


def test_bad_edge_lines_are_set_aside_with_file_and_reason(spark, text, path):
    lines = ["1 2", "3", "", "4 5 6", "x 1", "1 y", "1 2", "99999999999999999999 1"]
    where = text(*lines)
    good, bad = sources.quarantine_edges(spark, where, path, id_type="bigint")
    assert table(good) == table(sources.read_edge_list(spark, where, id_type="bigint")) == [(1, 2), (1, 2)]
    assert good.dtypes == [("src", "bigint"), ("dst", "bigint")]
    said = sorted((r.line, r.reason) for r in bad.collect())
    assert said == [
        ("", "1 fields, not 2"), ("1 y", "dst is no bigint"), ("3", "1 fields, not 2"), ("4 5 6", "3 fields, not 2"),
        ("99999999999999999999 1", "src is no bigint"), ("x 1", "src is no bigint")]
    assert all(r.file.endswith("lines.txt") for r in bad.collect()) and good.count() + bad.count() == len(lines)


def test_bad_links_are_set_aside(spark, text, path):
    where = text("h h h", "a b 200", "a b", "a b 1.5", "a b 1 9", "", "c d 7")
    good, bad = sources.quarantine_links(spark, where, path, header="h h h")
    assert table(good) == [("a", "b", 200), ("c", "d", 7)]
    assert sorted(r.line for r in bad.collect()) == ["", "a b", "a b 1 9", "a b 1.5"]


@pytest.mark.parametrize("lines", [(), ("1 2",), ("bad",)])
def test_quarantine_of_files_without_good_or_bad_lines(spark, text, path, lines):
    good, bad = sources.quarantine_edges(spark, text(*lines), path)
    assert (good.count(), bad.count()) == (lines.count("1 2"), lines.count("bad"))
