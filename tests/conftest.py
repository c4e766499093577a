import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    base = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("pagelake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own shared folder only because none is configured
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(base / "checkpoints"))
    yield s
    s.stop()


@pytest.fixture()
def store(spark, tmp_path):
    from pagelake.sources.tables import TableStore

    return TableStore(spark, str(tmp_path / "tables"))


# A small page of our own; its counts below are worked out by hand (FIXTURES.md, section 1).
SAMPLE_HTML = """<!doctype html>
<html><head><meta name="keywords" content="tea, coffee">
<title>Harbour Tea Room menu</title></head>
<body><a href="/menu/sencha">Sencha</a>
<table>
<tr><th>Drink</th><th>Cup</th><th>Pot</th></tr>
<tr><td>Sencha</td><td>3.20</td><td>5.80</td></tr>
<tr><td> Earl Grey </td><td>2.90</td><td>-</td></tr>
<tr><td>Mocha</td><td>4</td><td>N/A</td></tr>
<tr><td>Water</td><td>free</td><td>1.50</td></tr>
</table>
<p>Open from eight until the last ferry.</p>
<p>Cards welcome.</p>
<a href="/menu/mocha">Mocha</a> <a href="/contact">Write to us</a>
</body></html>
"""
SAMPLE_URL = "https://tearoom.example/menu"


@pytest.fixture()
def sample_pages(spark):
    return spark.createDataFrame([(1, SAMPLE_URL, SAMPLE_HTML)], "page_id long, url string, html string")
