"""Ids, maps, names, tokens."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodestone.functions.ids import id_from_json, id_text, id_to_json, int_id, string_id
from lodestone.functions.maps import merge_maps, set_if_absent
from lodestone.functions.scalars import default_source_name, first_nonempty_id, mime_from_extension, slug
from lodestone.functions.text import tokens, words
from lodestone.sources.specs import SourceSpec, resolve_source_ids, sources_table


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_integer_and_string_ids_differ(spark):
    assert not one(spark, int_id(F.lit(42)) == string_id(F.lit("42")))
    assert one(spark, int_id(F.lit(42)) == int_id(F.lit(42)))


def test_empty_string_id_is_set(spark):
    assert one(spark, string_id(F.lit("")).isNotNull())
    assert one(spark, string_id(F.lit(None).cast("string")).isNull())


@pytest.mark.parametrize(
    "literal, kind, text",
    [
        ("987654321", "int", "987654321"),
        ("-5", "int", "-5"),
        ("9007199254740993", "int", "9007199254740993"),
        ("18446744073709551616", "num", "18446744073709551616"),
        ("1.5", "num", "1.5"),
        ("1e3", "num", "1e3"),
        ('"42"', "str", "42"),
        ('""', "str", ""),
        ('"a\\"b\\u00e9"', "str", 'a"bé'),
    ],
)
def test_id_from_json(spark, literal, kind, text):
    row = one(spark, F.struct(id_from_json(F.lit(literal))["kind"].alias("k"), id_text(id_from_json(F.lit(literal))).alias("t")))
    assert (row["k"], row["t"]) == (kind, text)


@pytest.mark.parametrize("literal", ["42", '"42"', "1.5", "null", '""', '"a\\"b"'])
def test_id_round_trip(spark, literal):
    assert one(spark, id_to_json(id_from_json(F.lit(literal)))) == literal


def test_null_id_is_unset(spark):
    assert one(spark, id_from_json(F.lit("null")).isNull())


def test_extra_wins_and_absence_is_by_key(spark):
    base = F.create_map(F.lit("type"), F.lit("web"), F.lit("max_pages"), F.lit("10"))
    extra = F.create_map(F.lit("max_pages"), F.lit("25"), F.lit("type"), F.lit("other"))
    assert one(spark, merge_maps(base, extra)) == {"type": "other", "max_pages": "25"}
    assert one(spark, merge_maps(F.lit(None).cast("map<string,string>"), extra))["type"] == "other"
    null_text = F.create_map(F.lit("text"), F.lit(None).cast("string"))
    assert one(spark, set_if_absent(null_text, "text", F.lit("new"))) == {"text": None}
    assert one(spark, set_if_absent(base, "text", F.lit("new")))["text"] == "new"


@pytest.mark.parametrize(
    "text, want",
    [("Ünï Docs.Example!!", "n-docs-example"), ("  A  b ", "a-b"), ("---", "source"), ("", "source"), ("x", "x")],
)
def test_slug(spark, text, want):
    assert one(spark, slug(F.lit(text))) == want


def test_default_names(spark):
    specs = [
        SourceSpec("web", options={"start_urls": ["https://Example.com:8080/docs"]}),
        SourceSpec("web", options={"start_urls": ["not a url"]}),
        SourceSpec("web"),
        SourceSpec("s3", options={"bucket": "My_Docs"}),
        SourceSpec("s3"),
        SourceSpec("gdrive", options={"folder_ids": ["folder1"]}),
        SourceSpec("gdrive", options={"drive_id": "d1", "folder_ids": ["folder1"]}),
        SourceSpec("jira", options={"cloud_id": "c-1", "project_keys": ["ENG"]}),
        SourceSpec("jira"),
        SourceSpec("confluence", options={"cloud_id": "cloud-123", "spaces": ["HR"]}),
        SourceSpec("confluence", options={"base_url": "https://company.example.net"}),
        SourceSpec("file_upload"),
        SourceSpec("s3", name="mine", options={"bucket": "b"}),
    ]
    names = [r["name"] for r in sources_table(spark, specs).collect()]
    assert names == [
        "web-example-com",
        "web-not-a-url",
        "web-source",
        "s3-my-docs",
        "s3-source",
        "gdrive-folder1",
        "gdrive-d1",
        "jira-eng",
        "jira",
        "confluence-cloud-123",
        "confluence-https-company-example-net",
        "file-upload-source",
        "mine",
    ]


def test_config_defaults_and_precedence():
    assert SourceSpec("s3", options={"bucket": "b", "prefix": "", "max_file_size_mb": 0}).config() == {
        "type": "s3",
        "sync_mode": "incremental",
        "bucket": "b",
    }
    web = SourceSpec("web", options={"max_pages": 10, "allowed_domains": []}, extra={"max_pages": 25, "type": "x"})
    assert web.config() == {"type": "x", "max_pages": 25}
    assert SourceSpec("jira", options={"include_comments": False}).config()["include_comments"] is False
    assert SourceSpec("jira").config()["include_comments"] is True
    assert SourceSpec("file_upload").config()["sync_mode"] == "full"


def test_source_ids(spark):
    table = spark.createDataFrame([("", "s", "u"), ("i", "s", "u"), (None, "", "u"), ("", None, "")], "id string, source_id string, uuid string")
    good, bad = resolve_source_ids(table)
    assert rows(good, "resolved_id") == [("i",), ("s",), ("u",)]
    assert bad.count() == 1
    assert one(spark, first_nonempty_id(F.lit(""), F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    "name, want",
    [
        ("doc.txt", "text/plain; charset=utf-8"),
        ("a/b.c/README", "application/octet-stream"),
        ("a.PDF", "application/pdf"),
        ("a.tar.gz", "application/gzip"),
        ("x.unknownext", "application/octet-stream"),
    ],
)
def test_mime(spark, name, want):
    assert one(spark, mime_from_extension(F.lit(name))) == want


def test_explicit_name_wins(spark):
    assert one(spark, default_source_name(F.lit("web"), F.lit("n"), url=F.lit("http://a.b"))) == "n"


def test_tokens_and_words(spark):
    assert one(spark, tokens(F.lit("Été, 2nd-try! straße"))) == ["été", "2nd", "try", "straße"]
    assert one(spark, tokens(F.lit(None).cast("string"))) == []
    assert one(spark, words(F.lit("  a\n\tb "))) == ["a", "b"]
