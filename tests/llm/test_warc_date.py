"""Records carry the time in UTC, whatever the session's zone."""

import datetime as dt
import gzip
import re

from lotwise.llm import warc


def test_dates_are_utc(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        pages = spark.createDataFrame([(1, "http://a", "x")], "page_id long, url string, html string")
        warc.write_archives(pages, str(tmp_path / "archive"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    data = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "archive").glob("part-*"))
    (date,) = re.findall(rb"WARC-Date: (\S+)Z", data)
    written = dt.datetime.fromisoformat(date.decode()).replace(tzinfo=dt.UTC)
    assert abs((dt.datetime.now(dt.UTC) - written).total_seconds()) < 600
