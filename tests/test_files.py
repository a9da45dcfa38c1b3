"""Readers of landed files: documents and arrays, torn lines, and payloads of many vendors in one folder."""

from __future__ import annotations

import json

from dealweave.sources import files, landed


def put(folder, **content):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in content.items():
        (folder / name.replace("__", ".")).write_text(text)
    return str(folder)


def test_json_documents_arrays_and_unreadable_files(spark, tmp_path):
    recent = {"form": ["D", "10-K", "D/A", "D"], "filingDate": ["2024-01-02", "2024-01-03", "2024-01-04", "2023-01-01"], "accessionNumber": ["a", "b", "", "d"]}
    one, two = ({"cik": c, "filings": {"recent": recent}, "other": 1} for c in "12")
    path = put(tmp_path / "x", a__json=json.dumps(one, indent=2), b__json=json.dumps([one, two]), c__json='{"cik": "3", "filings"', d__json="")
    read = files.read_json(spark, path, landed.SUBMISSIONS_SCHEMA)
    got = landed.filings_columnar(read.rows, "2024-01-01").collect()
    assert sorted((r.cik, r.accession, r.dedup_key) for r in got) == [("1", "a", "form_d_1_a"), ("1", "a", "form_d_1_a"), ("2", "a", "form_d_2_a")]
    bad = read.unreadable.collect()
    assert [r.file.rsplit("/", 1)[1] for r in bad] == ["c.json"] and '"3"' in bad[0].content and bad[0].modified is not None


def test_csv_lines_are_rows_or_set_aside(spark, tmp_path):
    good = [f'{i},"Name, {i}",{i}.5' for i in range(20)]
    bad = ["x,not a number,1.0", "7,too,many,values", "8"]
    path = put(tmp_path / "r", a__csv="\n".join(["id,name,share", *good[:10], *bad]), b__csv="\n".join(["id,name,share", *good[10:]]))
    rows, unreadable, counts = files.quarantine(files.read_csv(spark, path, "id long, name string, share double"), str(tmp_path / "out"))
    assert counts == {"rows": 20, "unreadable": 3}
    assert sorted((r.id, r.name) for r in rows.collect()) == [(i, f"Name, {i}") for i in range(20)]
    assert sorted(r.content for r in unreadable.collect()) == sorted(bad)


def test_payloads_of_all_vendors_in_one_folder(spark, tmp_path):
    item = {"id": 5, "type": "story", "title": "Show HN: my startup launch", "url": None, "kids": [6, 7, 8], "descendants": 3}
    replies = [{"id": i, "type": "comment", "text": "<p>a reply long enough to be kept as context " + str(i)} for i in (6, 7, 8)]
    hits = {"hits": [{"objectID": "9", "title": " Show HN: launch ", "points": 3}, {"objectID": "10", "title": "Show HN: b", "url": "https://b.io"}], "page": 0}
    post = {"id": "1", "text": "see https://a.io", "author_id": "u2", "public_metrics": {"like_count": 4}, "entities": {"urls": [{"url": "https://t.co/1", "expanded_url": "https://b.io"}]}}
    search = {"data": [post, {**post, "id": "2", "author_id": "nobody"}], "includes": {"users": [{"id": "u2", "username": "ada"}, {"id": "u2", "username": "later"}, {"username": "no id"}]}}
    green = {"jobs": [{"id": 1, "title": "A", "absolute_url": "https://g/1", "departments": [{"name": "Eng"}], "content": "<b>x</b>"}]}
    lever = [{"id": "l", "text": "B", "hostedUrl": "https://l/1", "categories": {"team": "T"}}]
    ashby = {"jobs": [{"id": "a", "title": "C", "jobUrl": "https://a/1", "employmentType": "FullTime"}]}
    path = put(tmp_path / "all", acme__json="\n".join(map(json.dumps, [green, lever, ashby])), hn__jsonl="\n".join(map(json.dumps, [item, *replies, hits])) + "\n\n", x__json=json.dumps(search), torn__json='{"jobs": [', other__json='{"a": 1}')
    read = files.payloads(spark, path)
    assert [r.content for r in read.unreadable.collect()] == ['{"jobs": [']
    assert {(r.shape, r.n) for r in read.rows.groupBy("shape").count().withColumnRenamed("count", "n").collect()} == {("greenhouse", 1), ("lever", 1), ("ashby", 1), ("thread_item", 4), ("search_hits", 1), ("social_search", 1), (None, 1)}
    jobs = {r.external_id: r for r in files.job_shapes(read.rows).collect()}
    assert {(k, r.title, r.slug, r.ats_platform) for k, r in jobs.items()} == {("1", "A", "acme", "greenhouse"), ("l", "B", "acme", "lever"), ("a", "C", "acme", "ashby")}
    assert jobs["1"].department == "Eng" and jobs["l"].team == "T" and jobs["a"].commitment == "FullTime"
    posts = {r.post_id: (r.author, r.likes, r.urls) for r in files.social_posts(read.rows).collect()}
    assert posts == {"1": ("ada", 4, ["https://a.io", "https://b.io"]), "2": ("i", 4, ["https://a.io", "https://b.io"])}
    stories = {r.id: r for r in files.thread_stories(read.rows).collect()}
    assert set(stories) == {5, 9, 10} and len(stories[5].comments) == 3
    assert (stories[9].title, stories[9].url, stories[9].points, stories[10].url) == ("Show HN: launch", "https://news.ycombinator.com/item?id=9", 3, "https://b.io")


def test_a_payload_is_parsed_once_a_row(spark, tmp_path):
    path = put(tmp_path / "all", a__json='{"id": 5, "type": "story", "title": "Show HN: launch", "text": "", "kids": []}')
    rows = files.payloads(spark, path).rows

    def parses(df):
        return df._jdf.queryExecution().optimizedPlan().toString().lower().replace("_", "").count("parsejson")

    assert parses(rows) == parses(rows.filter("shape = 'thread_item'")) == 1
    assert parses(files.thread_stories(rows)) == 0  # reads the table of what was parsed
