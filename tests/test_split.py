"""Text read by many tasks against the same text read by one."""

import random

import pytest

import columnlens as cl


@pytest.fixture
def small_blocks(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, str(size))
    spark.conf.set(name, before)


def same(spark, path, sep="\t"):
    want, got = cl.read_table(spark, path, sep=sep), cl.read_split_table(spark, path, sep=sep)
    assert want.columns == got.columns
    key = lambda r: tuple((v is None, v or "") for v in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((tuple(r) for r in want.collect()), key=key)
    return got


@pytest.mark.parametrize("seed", range(4))
def test_cells_with_line_ends(spark, tmp_path, small_blocks, seed):
    """As the CSV sink quotes them: line ends, separators, quotes and backslashes in any cell."""
    rng = random.Random(seed)
    cell = lambda: rng.choice([None, "", "a", "two\nlines", "\n\n", 'say "x"\n', "t\tab", "ü", "back\\slash", "x\ny\n" * 30])
    rows = [(str(i), cell(), cell(), cell()) for i in range(150)]
    frame = spark.createDataFrame(rows, "id string, `a.b` string, c string, `two\nlines` string")
    frame.coalesce(1).write.option("header", True).option("sep", "\t").csv(str(tmp_path / "t"))
    small_blocks(rng.choice([97, 256, 1 << 20]))
    assert same(spark, str(tmp_path / "t")).count() == 150


def test_quotes_inside_of_plain_cells(spark, tmp_path, small_blocks):
    lines = ["id\tsize\tnote", '1\t5" pipe\tx', '2\ty\t"one', '', 'more" rest\tz', "3\t\t", '4\t"a\tb"\t"\\"q\\""', "", '5\t"open\\', 'end"\tok']
    (tmp_path / "t.tsv").write_text("\n".join(lines) + "\n")
    for size in (16, 40, 1 << 20):
        small_blocks(size)
        found = {r["id"]: tuple(r)[1:] for r in cl.read_split_table(spark, str(tmp_path / "t.tsv")).collect()}
        assert found["1"] == ('5" pipe', "x") and found["3"] == (None, None) and found["4"] == ("a\tb", '"q"')
        assert set(found) == {"1", "2", "3", "4", "5"}


def test_several_files_and_none_of_rows(spark, tmp_path, small_blocks):
    small_blocks(50)
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text("a,b\n" + "".join(f'{i}{j},"x\ny{j}"\n' for j in range(20)))
    assert same(spark, str(tmp_path), ",").count() == 60
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.tsv").write_text("a\tb\n")
    assert same(spark, str(tmp_path / "empty" / "e.tsv")).count() == 0


def test_blocks_are_read_by_several_tasks(spark, tmp_path, small_blocks):
    (tmp_path / "t.tsv").write_text("a\tb\n" + 'x\t"1\n2"\n' * 500)
    small_blocks(1000)
    assert spark.read.text(str(tmp_path / "t.tsv")).rdd.getNumPartitions() > 3
    assert cl.read_table(spark, str(tmp_path / "t.tsv")).rdd.getNumPartitions() == 1
    assert same(spark, str(tmp_path / "t.tsv")).count() == 500


def test_jobs_choose_a_reader(spark, tmp_path, monkeypatch):
    from columnlens.plans import jobs

    (tmp_path / "t.tsv").write_text("a\tb\n" + 'x\t"1\n2"\n' * 50)
    spark.read.text(str(tmp_path / "t.tsv")).write.option("compression", "gzip").text(str(tmp_path / "z"))
    used = []
    for name in ("read_table", "read_split_table"):
        read = getattr(jobs, name)
        monkeypatch.setattr(jobs, name, lambda *a, read=read, name=name, **k: used.append((name, *k)) or read(*a, **k))
    assert jobs.read_dealt(spark, str(tmp_path / "t.tsv")).count() == 50
    monkeypatch.setattr(jobs, "ONE_TASK", 10)
    assert jobs.read_dealt(spark, str(tmp_path / "t.tsv")).count() == 50
    jobs.read_dealt(spark, str(tmp_path / "z"))
    assert used == [("read_table",), ("read_split_table",), ("read_table", "partitions")]
