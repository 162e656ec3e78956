import pytest
from pyspark.sql import functions as F

from folioforge.sources.paged import read_pages


def opener():
    """Packed pages: texts between form feeds, read without the ones before them."""

    class Packed:
        def count(self, path):
            with open(path) as f:
                text = f.read()
            return text.count("\f") + 1 if text else 0

        def texts(self, path, first, end):
            with open(path) as f:
                yield from f.read().split("\f")[first:end]

    return Packed()


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    for name, n in (("a", 120), ("b", 1), ("none", 0)):
        (tmp_path / name).write_text("\f".join(f"{i + 5}\nPage {i} of {name}\né" for i in range(n)))
    rows = read_pages(spark, [str(tmp_path / n) for n in ("a", "b", "none")], opener(), each=25)
    tasks = rows.filter(F.col("path").endswith("a")).select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks == 5
    got = sorted((r.path[-1], r.pdf_page_index, r.printed_page_number, r.raw_text) for r in rows.collect())
    assert got == sorted((name, i, str(i + 5), f"{i + 5}\nPage {i} of {name}\né") for name, n in (("a", 120), ("b", 1)) for i in range(n))


def test_a_missing_file_raises(spark, tmp_path):
    with pytest.raises(Exception, match="No such file"):
        read_pages(spark, [str(tmp_path / "x")], opener()).collect()
