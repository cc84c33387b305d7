"""Zipped text on its way to a parser."""

import zipfile

from tidemark.sources import parsers, readers


def test_zipped_lines(spark, tmp_path):
    fields = [""] * 27
    fields[1], fields[3], fields[4], fields[26] = "20210104120000", "site", "u", "<PAGE_TITLE>Grüße</PAGE_TITLE>"
    line = "\t".join(fields)
    for name, text in (("a.zip", (line + "\r\nshort\n").encode() + b"\xff\n"), ("b.zip", line.replace("\tu\t", "\tv\t").encode()), ("empty.zip", b"")):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("part.csv", text)
    (tmp_path / "broken.zip").write_bytes(b"no archive")
    lines = readers.zipped_lines(spark, f"file://{tmp_path}/*.zip")
    assert sorted(r.value for r in lines.collect()) == sorted([line, "short", "", line.replace("\tu\t", "\tv\t")])
    got = parsers.news_gkg(lines).collect()
    assert sorted((r.url, r.title, r.entity) for r in got) == [("u", "Grüße", "site"), ("v", "Grüße", "site")]


def test_many_lines(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("part.csv", "\n".join(map(str, range(50_001))))
    assert readers.zipped_lines(spark, f"file://{tmp_path}/a.zip").distinct().count() == 50_001
