"""Audio exports in every form, and the download step."""

import bz2
import csv
import io
import random
import tarfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sentaria.functions.scalar import is_reusable_license
from sentaria.operators.audio import download, plan_downloads
from sentaria.sources.exports import extract_audio, read_audio_export

DRAW = random.Random(4)
#: Drawn export lines, among them short, long, empty and quoted ones.
LINES = [
    DRAW.choice(["{i}\tr{i}\tines\tCC0\t", "{i}\tr{i}\ttomo\tCC BY-SA\thttps://a.example/{i}", "{i}\tr{i}", "{i}\tr{i}\t\t\\N\t",
                 " {i} \t r{i} \tpia\t \t", "{i}", "", "n{i}\tr{i}\tines\tCC0\t", '{i}\tr{i}\t"pia\ttwo"\t"an ""odd"" one"\t',
                 "{i}\t\tines\tCC0\t", "{i}.5\tr{i}\t\t\t", "+{i}\tr{i}\ttomo\tCC0\t\tmore\tfields", "{i}\tr{i}\tÆther\tCC0\t"]).format(i=i)
    for i in range(300)
]


def expected(lines):
    """What the export says, read line by line."""
    out = []
    for fields in csv.reader(lines, delimiter="\t"):
        if len(fields) < 2:
            continue
        try:
            number = int(fields[0])
        except ValueError:
            continue
        user, licence, link = [x.strip() or None for x in (*fields[2:5], "", "", "")[:3]]
        out.append((number, fields[1].strip(), user, licence, link))
    return sorted(out, key=str)


def write_export(folder: Path, kind: str, lines: list[str]) -> str:
    content = "".join(line + "\n" for line in lines).encode()
    path = folder / f"audio.{kind}"
    if kind in ("tsv", "tsv.bz2"):
        path.write_bytes(content if kind == "tsv" else bz2.compress(content))
        return str(path)
    with tarfile.open(path, "w:bz2", format=tarfile.PAX_FORMAT if "pax" in folder.name else tarfile.GNU_FORMAT) as archive:
        for name, data in (("notes", None), ("notes/audio.csv", content), ("notes/later.csv", b"1\tlate\tx\ty\tz\n" * 40)):
            member = tarfile.TarInfo(name)
            member.mtime = 1234.5 if "pax" in folder.name else 1234
            if data is None:
                member.type = tarfile.DIRTYPE
            member.size = len(data or b"")
            archive.addfile(member, io.BytesIO(data or b""))
    return str(path)


def rows_of(df):
    names = ("sentence_id", "audio_id", "username", "license", "attribution_url")
    return sorted((tuple(row[n] for n in names) for row in df.collect()), key=str)


@pytest.fixture(params=["tsv", "tsv.bz2", "tar.bz2", "tar.bz2-pax"])
def export(request, tmp_path):
    kind, _, variant = request.param.partition("-")
    folder = tmp_path / (variant or "plain")
    folder.mkdir()
    return write_export(folder, kind, LINES)


def test_export_equals_reading_by_line(spark, export):
    rows = read_audio_export(spark, export)
    assert rows_of(rows) == expected(LINES)
    fixed = {(r["source"], r["status"], r["local_path"], r["downloaded_at"]) for r in rows.collect()}
    assert fixed == {("tatoeba", "metadata", None, None)}
    assert all(r["download_url"] == f"https://tatoeba.org/audio/download/{r['audio_id']}" for r in rows.collect())


def test_allow_list(spark, export):
    kept = spark.range(40, 90).select(F.col("id").alias("sentence_id"))
    want = [row for row in expected(LINES) if 40 <= row[0] < 90]
    assert want and rows_of(read_audio_export(spark, export, kept)) == want
    assert rows_of(read_audio_export(spark, export, kept.limit(0))) == []


def test_an_archive_is_read_in_several_tasks(spark, tmp_path):
    noise = random.Random(1)
    lines = [f"{i}\tr{i}\t{noise.randbytes(40).hex()}\tCC0\t" for i in range(40_000)]
    path = write_export(tmp_path, "tar.bz2", lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400k")
    try:
        rows = read_audio_export(spark, path)
        tasks = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(tasks) > 2 and sum(tasks) == 40_000
        assert rows.agg(F.countDistinct("sentence_id")).first()[0] == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_breaks_in_quotes(spark, tmp_path):
    path = tmp_path / "audio.tsv"
    path.write_text('1\ta\t"two\nlines"\tCC0\t\n2\tb\tx\tCC0\t\n')
    rows = read_audio_export(spark, str(path), multi_line=True).collect()
    assert sorted((r["sentence_id"], r["username"]) for r in rows) == [(1, "two\nlines"), (2, "x")]


def test_reusable_license(spark):
    texts = ["CC0", " ", "", None, "\\N", " \\N "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    assert [r[0] for r in df.orderBy("i").select(is_reusable_license(F.col("x"))).collect()] == [
        True, False, False, False, False, False
    ]


def test_downloads(spark, tmp_path):
    """Licensed rows are fetched unless their file is there; some fetches break off halfway."""
    rows = read_audio_export(spark, write_export(tmp_path, "tsv", LINES)).filter("audio_id <> ''")
    folder, calls = tmp_path / "files", tmp_path / "calls"
    calls.mkdir()
    (folder / "tatoeba").mkdir(parents=True)
    listed = {row[1]: row[3] for row in expected(LINES) if row[1]}
    licensed = {a for a, licence in listed.items() if licence not in (None, "\\N")}
    there = set(sorted(licensed)[::5])
    broken = set(sorted(licensed)[1::5])
    for name in there:
        (folder / "tatoeba" / f"{name}.mp3").write_bytes(b"kept")

    def fetch(url, target):
        name = url.rsplit("/", 1)[1]
        (calls / name).write_text(url)
        Path(target).write_bytes(b"new")
        if name in broken:
            raise OSError("broken off")

    stamp = F.to_timestamp(F.lit("2024-05-01 10:00:00"))
    out = {r["audio_id"]: r for r in download(rows, str(folder), fetch, fetched_at=stamp).collect()}
    for name, licence in listed.items():
        row = out[name]
        if name not in licensed:
            assert (row["status"], row["local_path"], row["downloaded_at"]) == ("skipped_license", None, None)
        elif name in broken:
            assert (row["status"], row["local_path"], row["downloaded_at"]) == ("download_error", None, None)
            assert not (folder / "tatoeba" / f"{name}.mp3").exists()
        else:
            assert row["status"] == "downloaded" and row["downloaded_at"] == datetime(2024, 5, 1, 10)
            assert Path(row["local_path"]).read_bytes() == (b"kept" if name in there else b"new")
    assert {p.name for p in calls.iterdir()} == licensed - there


def test_all_licenses_can_be_planned(spark, tmp_path):
    rows = read_audio_export(spark, write_export(tmp_path, "tsv", LINES))
    planned = plan_downloads(rows, "/data/", reusable_only=False).collect()
    assert {(r["status"], r["local_path"]) for r in planned} == {
        ("downloaded", f"/data/tatoeba/{row[1]}.mp3") for row in expected(LINES)
    }


def test_extract_without_fetch_is_metadata_only(spark, tmp_path):
    rows = extract_audio(spark, write_export(tmp_path, "tsv", LINES))
    assert {r["status"] for r in rows.collect()} == {"metadata"}


def test_fetches_of_one_small_file_are_dealt_over_the_cores(spark, tmp_path):
    from sentaria.operators.audio import audio_rows, download

    raw = spark.createDataFrame(
        [(str(k), f"rec{k}", "ines", "CC0", "") for k in range(60)],
        "sentence_id string, audio_id string, username string, license string, attribution_url string",
    )
    raw.coalesce(1).write.parquet(str(tmp_path / "export"))
    raw = spark.read.parquet(str(tmp_path / "export"))

    def fetch(url, path):
        with open(path, "x") as out:  # a new file each time
            out.write(url)
        if "rec7." in url or url.endswith("rec7"):
            raise OSError("refused after a part was written")

    rows = download(audio_rows(raw), str(tmp_path / "audio"), fetch)
    assert rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    found = {r["audio_id"]: r["status"] for r in rows.collect()}
    assert len(found) == 60 and {a for a, s in found.items() if s == "download_error"} == {"rec7"}
    assert len(list((tmp_path / "audio" / "tatoeba").iterdir())) == 59
