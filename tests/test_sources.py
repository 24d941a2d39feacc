import datetime as dt

from pyspark.sql import functions as F

from roadlark import schemas
from roadlark.sources import pages as timeline, posts as raw


def test_day_files(spark):
    got = raw.day_files(spark, "raw/scrape", dt.date(2024, 12, 31), dt.date(2025, 1, 1))
    assert got == ["raw/scrape/2024/12/scrape_data_20241231.csv", "raw/scrape/2025/01/scrape_data_20250101.csv"]
    assert raw.day_files(spark, "r", dt.date(2025, 1, 2), dt.date(2025, 1, 1)) == []
    assert raw.day_before(dt.date(2025, 1, 1)) == dt.date(2024, 12, 31)


def test_csv_quirks_and_missing_files(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('content,tweetlinkid,created_at\n"say ""hi""\nthere, now ",  u1 ,2025-01-01 00:00:00+08:00\n,,\n')
    rows = raw.read_posts(spark, [str(path), str(tmp_path / "none.csv")]).collect()
    # White space is trimmed around a bare field, not inside quotes.
    assert (rows[0].content, rows[0].tweetlinkid, rows[0].created_at) == (
        'say "hi"\nthere, now ', "u1", dt.date(2025, 1, 1))
    assert tuple(rows[1]) == (None, None, None)
    empty = raw.read_posts(spark, str(tmp_path / "none.csv"))
    assert empty.count() == 0 and empty.columns == ["content", "tweetlinkid", "created_at"]


def test_file_order_follows_the_rows(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("content,tweetlinkid,created_at\n" + "".join(f"p{i},u,2025-01-01\n" for i in range(50)))
    rows = raw.with_file_order(raw.read_posts(spark, str(path))).orderBy("post_seq").collect()
    assert [r.content for r in rows] == [f"p{i}" for i in range(50)]
    assert {r.source_file for r in rows} == {f"file:{path}"} or all("a.csv" in r.source_file for r in rows)


def test_historical_keeps_three_columns(spark, tmp_path):
    path = tmp_path / "h.csv"
    header = [f.split()[0] for f in schemas.RAW_HISTORICAL.split(", ")]
    path.write_text(",".join(header) + "\n2025-01-01,8:00 AM,Pasig,X,1,2,3,NB,T,1,CAR,the tweet,the source\n")
    (row,) = raw.read_historical(spark, str(path)).collect()
    assert row.asDict() == {"content": "the tweet", "created_at": dt.date(2025, 1, 1), "tweetlinkid": "the source"}


def test_day_folders_round_trip_and_replace(spark, tmp_path):
    root = str(tmp_path / "csv")
    rows = [('a "b", c\nd', "u1", dt.date(2025, 1, 1)), ("e", "u2", dt.date(2025, 2, 3))]
    posts = spark.createDataFrame(rows, schemas.RAW_POSTS)
    raw.write_day_folders(posts, root)
    raw.write_day_folders(posts.where("content = 'e'"), root)  # replaces that day only
    got = raw.read_day_folders(spark, root, dt.date(2025, 1, 1), dt.date(2025, 12, 31)).collect()
    assert sorted(map(tuple, got)) == sorted(rows)
    one = raw.read_day_folders(spark, root, dt.date(2025, 2, 1), dt.date(2025, 2, 28))
    assert [r.content for r in one.collect()] == ["e"]
    assert raw.read_day_folders(spark, str(tmp_path / "no"), dt.date(2025, 1, 1), dt.date(2025, 1, 1)).count() == 0


ITEM = (
    '<div class="timeline-item "><a class="tweet-link" href="/x"></a><div class="tweet-body">'
    '<span class="tweet-date"><a href="https://nitter.net/MMDA/status/{n}#m" title="{title}">x</a></span>'
    '<div class="tweet-content media-body" dir="auto">{text}</div></div></div>'
)


def page(*items):
    return "<html>" + "".join(items) + "</html>"


def test_extract_posts(spark):
    good = ITEM.format(n=1, title="Jan 5, 2024 · 8:00 AM UTC", text="MMDA ALERT: A &amp; B<br>at <b>EDSA</b> ")
    other_day = ITEM.format(n=2, title="Jan 15, 2024 · 8:00 AM UTC", text="MMDA ALERT: C")
    no_mark = ITEM.format(n=3, title="Jan 5, 2024 · 8:00 AM UTC", text="mmda alert")
    bad_date = ITEM.format(n=4, title="yesterday", text="MMDA ALERT: D")
    no_content = ITEM.replace("tweet-content", "other").format(n=5, title="Jan 5, 2024 · 8:00 AM UTC", text="MMDA ALERT")
    pages = spark.createDataFrame(
        [(1, page(good, other_day, no_mark)), (2, page(bad_date, no_content)), (3, ""), (4, None)],
        "page_id int, html string",
    )
    rows = timeline.extract_posts(pages).orderBy("tweetlinkid").collect()
    assert [tuple(r) for r in rows] == [
        ("MMDA ALERT: A & B\nat EDSA", "https://x.com/MMDA/status/1#m", dt.date(2024, 1, 5)),
        ("MMDA ALERT: C", "https://x.com/MMDA/status/2#m", dt.date(2024, 1, 15)),
    ]
    assert timeline.extract_posts(pages, day=dt.date(2024, 1, 15)).count() == 1
    ordered = timeline.extract_posts(pages, order="page_id").orderBy("post_seq").collect()
    assert [r.post_seq for r in ordered] == [0, 1]


def test_posts_are_numbered_over_pages_of_any_number_and_size(spark):
    item = lambda n: ITEM.format(n=n, title="Jan 5, 2024 · 8:00 AM UTC", text=f"MMDA ALERT: {n}")
    numbers = [-5, 3, 2**43, 2**62]
    pages = [(n, page(*[item(i) for i in range(40 * k, 40 * k + 40)])) for k, n in enumerate(numbers)]
    df = spark.createDataFrame(pages[::-1], "page_id long, html string")
    found = {r.post_seq: r.content for r in timeline.extract_posts(df, order="page_id").collect()}
    assert found == {i: f"MMDA ALERT: {i}" for i in range(160)}
    texts = df.select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("page_id"), "html")
    assert timeline.extract_posts(texts, order="page_id").agg(F.max("post_seq")).first()[0] == 159


def test_pages_as_servers_write_them(spark):
    item = (
        '<article id="a" class=\'card timeline-item\' data-n="1"><div dir="auto" class="tweet-content media-body">'
        'MMDA ALERT: Do&ntilde;a &#209;o &#xF1; &amp;lt; &amp;#38; R&D &bogus; &#xD800; &#9999999;</div>'
        '<p class="x tweet-date"><a title="Jan 5, 2024 &middot; 8:00 AM UTC" href="{href}">x</a></p></article>'
    )
    links = {1: "/MMDA/status/1#m", 2: "//nitter.net/MMDA/status/2", 3: "https://nitter.net/MMDA/status/3"}
    near = '<div class="timeline-items"></div><div data-class="timeline-item"></div>'
    pages = spark.createDataFrame([(n, page(near, item.format(href=h), near)) for n, h in links.items()],
                                  "page_id int, html string")
    rows = timeline.extract_posts(pages).orderBy("tweetlinkid").collect()
    assert [r.tweetlinkid for r in rows] == [
        "https://x.com/MMDA/status/1#m", "https://x.com/MMDA/status/2", "https://x.com/MMDA/status/3"]
    assert {r.content for r in rows} == {
        "MMDA ALERT: Doña Ño ñ &lt; &#38; R&D &bogus; &#xD800; &#9999999;"}
    assert {r.created_at for r in rows} == {dt.date(2024, 1, 5)}


def test_both_layouts_of_days_are_read(spark, tmp_path, caplog):
    root = tmp_path / "raw"
    (root / "2025" / "01").mkdir(parents=True)
    (root / "2025" / "01" / "scrape_data_20250101.csv").write_text("content,tweetlinkid,created_at\na,u,2025-01-01\n")
    later = [("b", "u", dt.date(2025, 1, 2)), ("c", "u", dt.date(2025, 2, 1)), ("d", "u", dt.date(2025, 2, 2))]
    raw.write_day_folders(spark.createDataFrame(later, schemas.RAW_POSTS), str(root))
    got = raw.read_days(spark, str(root), dt.date(2025, 1, 1), dt.date(2025, 2, 1))
    assert sorted(r.content for r in got.collect()) == ["a", "b", "c"]
    assert got.columns == ["content", "tweetlinkid", "created_at"] and not caplog.records
    assert raw.read_days(spark, str(root), dt.date(2026, 1, 1), dt.date(2026, 1, 2)).count() == 0
    assert "no raw posts" in caplog.text


def test_next_link(spark):
    more = '<div class="show-more"><a href="{}">more</a></div>'
    cases = {
        more.format("/MMDA") + more.format("?cursor=a&amp;b"): "https://nitter.net/MMDA?cursor=a&b",
        more.format("/MMDA?cursor=q"): "https://nitter.net/MMDA?cursor=q",
        more.format("https://other/x"): "https://other/x",
        "<p>none</p>": None,
    }
    df = spark.createDataFrame([(i, h) for i, h in enumerate(cases)], "n int, html string")
    got = df.orderBy("n").select(timeline.resolve_link(timeline.next_link(F.col("html")))).collect()
    assert [r[0] for r in got] == list(cases.values())
