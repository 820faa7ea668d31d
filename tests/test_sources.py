import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from outbreaklens.operators import star
from outbreaklens.sources import readers, writers


def test_csv_readers(spark, tmp_path):
    cases = tmp_path / "cases.csv"
    cases.write_text('date,nom,cumulative_confirmed_cases,note\n2026-06-01,Bunia,ND,"a, ""b"""\n2026-06-02],,17-,NA\n')
    rows = readers.zone_cases(spark, str(cases)).collect()
    assert [r.asDict() for r in rows] == [
        {"date": "2026-06-01", "nom": "Bunia", "cumulative_confirmed_cases": "ND", "note": 'a, "b"'},
        {"date": "2026-06-02]", "nom": None, "cumulative_confirmed_cases": "17-", "note": None},
    ]
    with pytest.raises(ValueError, match="cumulative_confirmed_deaths"):
        readers.zone_deaths(spark, str(cases))


def test_national(spark, tmp_path):
    (tmp_path / "c.csv").write_text("nom,date,national_cumulative_confirmed_cases\nCOD,2026-05-14,2\nCOD,2026-05-16,0\n")
    (tmp_path / "d.csv").write_text("date,national_cumulative_confirmed_deaths\n2026-05-14,1\n2026-05-15,3\n2026-05-16,1\n")
    cases = readers.national_cases(spark, str(tmp_path / "c.csv"))
    deaths = readers.national_deaths(spark, str(tmp_path / "d.csv"))
    national = star.with_cfr(star.national_table(cases, deaths)).orderBy("date").collect()
    assert [(str(r["date"]), r["nom"], r["cfr"]) for r in national] == [
        ("2026-05-14", "COD", 50.0), ("2026-05-15", None, None), ("2026-05-16", "COD", None),
    ]


def test_geojson(spark, tmp_path):
    density = {"pop_density": {"pop_density": 12.5}}
    features = [
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]},
         "properties": {"nom": "Bunia", "province": "Ituri", "worldpop": density, "gdp_pc": {"gdp_pc": {"gdp_pc": 300}}}},
        {"properties": {"nom": "Aru", "worldpop": {}, "grid3_healthsites": {"healthsite_density": {"healthsite_density": 0.2}}}},
    ]
    path = tmp_path / "zones.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    rows = star.health_zones(readers.zone_features(spark, str(path))).collect()
    assert [tuple(r) for r in rows] == [("Bunia", "Ituri", 12.5, None, 300.0), ("Aru", None, None, 0.2, None)]


def test_bulletin_files(spark, tmp_path):
    (tmp_path / "DON2_2026-05-29.txt").write_text("zwei\nZeilen é", encoding="utf-8")
    (tmp_path / "DON1_2026-05-17.txt").write_bytes(b"eins\r\ndrei\rvier")
    (tmp_path / "notes.md").write_text("no bulletin")
    rows = readers.bulletins(spark, str(tmp_path)).orderBy("bulletin").collect()
    assert [tuple(r) for r in rows] == [("DON1_2026-05-17", "eins\ndrei\nvier"), ("DON2_2026-05-29", "zwei\nZeilen é")]
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        readers.bulletins(spark, str(tmp_path / "empty")).collect()


def test_extractions_roundtrip(spark, tmp_path):
    assert readers.extractions(spark, str(tmp_path / "absent")).count() == 0
    rows = [("DON1", ["Haut-Uélé"], [(5, "cases", "...é…")], [("p", "routine update", 0.5)])]
    records = spark.createDataFrame(rows, readers.EXTRACTION)
    writers.write_extractions(records, str(tmp_path / "x"))
    assert "Haut-Uélé" in "".join(f.read_text(encoding="utf-8") for f in (tmp_path / "x").glob("part-*"))
    assert readers.extractions(spark, str(tmp_path / "x")).collect() == records.collect()
    listed = tmp_path / "list.json"
    listed.write_text(json.dumps([{"bulletin": "A"}, {"bulletin": "B", "locations_mentioned": ["Goma"]}], indent=2))
    got = readers.extractions(spark, str(listed), multi_line=True).collect()
    assert [r["bulletin"] for r in got] == ["A", "B"] and got[1]["locations_mentioned"] == ["Goma"]


def test_append_only_new_articles(spark, tmp_path):
    path = str(tmp_path / "articles")
    first = spark.createDataFrame([("A", "one")], "name string, article string")
    writers.write_table(first.withColumn("n_chars", F.length("article")), path)
    manifest = spark.createDataFrame([("A", "changed"), ("B", "four")], "name string, article string")
    writers.append_articles(manifest, spark.read.parquet(path), path)
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {("A", "one", 3), ("B", "four", 4)}


def test_integrity(spark, tmp_path):
    (tmp_path / "small.pdf").write_bytes(b"x" * 999)
    (tmp_path / "large.pdf").write_bytes(b"x" * 1000)
    rows = readers.file_integrity(spark, str(tmp_path / "*.pdf")).collect()
    assert {r["path"].rsplit("/", 1)[1]: r["looks_broken"] for r in rows} == {"small.pdf": True, "large.pdf": False}


    assert [r[0] for r in readers.missing_files(readers.file_integrity(spark, str(tmp_path / "*.pdf")), ["a.pdf", "small.pdf"]).collect()] == ["a.pdf"]


def test_manifest(spark):
    rows = readers.bulletin_manifest(spark).orderBy("name").collect()
    assert len(rows) == 7
    assert (rows[-1]["number"], str(rows[-1]["published"])) == ("DON614", "2026-08-01")


def test_spread_leaves_wide_scans_alone(spark):
    assert readers.spread(spark.range(10, numPartitions=2)).rdd.getNumPartitions() == 8
    assert readers.spread(spark.range(10, numPartitions=9)).rdd.getNumPartitions() == 9


NASTY = [
    ("plain", "b", "c"), ('two "quoted"', "line\nbreak", ""), ("a,b", "many\n\nbreaks\nin\none", 'x"y'), ("", "", "z"),
    ("é" * 40, "commas,,,\nand \"quotes\"\n", "end"), ("ND", "NA", "3"),
]


def written(rows, path, end="\n"):
    import csv

    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(["a", "b", "c"])
        writer.writerows(rows)


@pytest.mark.parametrize("split_bytes, end", [(24, "\n"), (61, "\r\n"), (1 << 20, "\n")])
def test_split_csv_equals_whole_files(spark, tmp_path, split_bytes, end):
    """Quoted line breaks at every border of splits; a bare quote that opens nothing; two files."""
    written(NASTY * 7, tmp_path / "one.csv", end)
    written(NASTY[::-1] * 3, tmp_path / "two.csv", end)
    (tmp_path / "three.csv").write_text('a,b,c\n5" wide,"ok ""then""",6"\n\n"x\n,""\ny",,2\n')
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(key) for key in keys]
    try:
        spark.conf.set(keys[0], str(split_bytes))
        spark.conf.set(keys[1], "0")
        got = readers.csv_table(spark, str(tmp_path), entry=True, split=True)
        if split_bytes < 100:
            assert got.rdd.getNumPartitions() > 10
        rows = got.collect()
        whole = readers.csv_table(spark, str(tmp_path)).collect()
        assert sorted(map(str, (r[:3] for r in rows))) == sorted(map(str, (tuple(r) for r in whole)))
        first = [tuple(r)[:3] for r in sorted(rows, key=lambda r: tuple(r[3])) if r[3]["file"].endswith("one.csv")]
        assert first == [tuple(r) for r in readers.csv_table(spark, str(tmp_path / "one.csv")).collect()]
    finally:
        for key, value in zip(keys, before):
            spark.conf.set(key, value)


def test_split_csv_with_other_headers(spark, tmp_path):
    written(NASTY, tmp_path / "one.csv")
    (tmp_path / "two.csv").write_text("a,b,d\n1,2,3\n")
    with pytest.raises(Exception, match="another header"):
        readers.csv_table(spark, str(tmp_path), split=True).collect()
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "head.csv").write_text("a,b,c\n")
    assert readers.csv_table(spark, str(tmp_path / "none"), split=True).collect() == []


def test_star_versions(spark, tmp_path):
    """A failed replacement leaves all tables of the version before; the next one shows all of its own."""
    folder, names = str(tmp_path / "star"), ["a", "b"]
    with pytest.raises(FileNotFoundError):
        readers.current_tables(spark, folder, names)
    writers.replace_tables({name: spark.range(3) for name in names}, folder)
    broken = {"a": spark.range(7), "b": spark.range(7).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))}
    with pytest.raises(Exception, match="lost"):
        writers.replace_tables(broken, folder)
    assert [readers.current_tables(spark, folder, names)[name].count() for name in names] == [3, 3]
    writers.replace_tables({name: spark.range(5) for name in names}, folder)
    assert [readers.current_tables(spark, folder, names)[name].count() for name in names] == [5, 5]
    assert spark.table("a").count() == 5


def test_written_bulletins(spark, tmp_path):
    texts = spark.createDataFrame([("DON1_2026-05-17", "eins\nzwei é"), ("DON2_2026-05-18", None)], "bulletin string, text string")
    writers.write_bulletins(texts, str(tmp_path / "x"))
    rows = readers.bulletins(spark, str(tmp_path / "x"), partitioned=True).orderBy("bulletin").collect()
    assert [tuple(r) for r in rows] == [("DON1_2026-05-17", "eins\nzwei é\n"), ("DON2_2026-05-18", "\n")]
    with pytest.raises(ValueError, match="DON1"):
        writers.write_bulletins(texts.union(texts), str(tmp_path / "y"))


def test_written_bulletins_keep_their_names_in_few_folders(spark, tmp_path):
    """One file a bulletin, named after it; Spark's writer made a folder for each of them."""
    names = [f"DON{i}_2026-05-17" for i in range(300)] + ["_a b+c/ü%41.x", ".txt", "", None]
    texts = spark.createDataFrame([(name, f"{name}\r\nzwei é") for name in names], "bulletin string, text string")
    for _ in range(2):  # a second call replaces the files
        writers.write_bulletins(texts, str(tmp_path / "x"))
    rows = readers.bulletins(spark, str(tmp_path / "x"), partitioned=True).collect()
    assert {r["bulletin"]: r["text"] for r in rows} == {name: f"{name}\nzwei é\n" for name in names} and len(rows) == len(names)
    files = [f for f in (tmp_path / "x").rglob("*") if f.is_file()]
    assert len(files) == len(names) and len({f.parent for f in files}) == 1
    assert {f"{name}.txt" for name in names[:300]} <= {f.name for f in files}
    writers.write_bulletins(texts.limit(0), str(tmp_path / "x"))
    assert not [f for f in (tmp_path / "x").rglob("*") if f.is_file()]


def test_bulletin_files_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """The driver knows folders, not files, and a task reads several folders; texts of any size come back whole."""
    monkeypatch.setattr(writers, "FOLDER_FILES", 10)
    monkeypatch.setattr(readers, "BATCH_BYTES", 1000, raising=False)
    wanted = {f"DON{i}_2026-05-17": f"é {i}\n" * (i % 7) + "x" * (5000 * (i % 50 == 0)) for i in range(300)}
    writers.write_bulletins(spark.createDataFrame(list(wanted.items()), "bulletin string, text string"), str(tmp_path / "x"))
    (tmp_path / "x" / "_SUCCESS").touch()
    read = readers.bulletins(spark, str(tmp_path / "x"), partitioned=True)
    assert read.inputFiles() == [] and read.rdd.getNumPartitions() <= 8 < len(list((tmp_path / "x").glob("part=*")))
    rows = read.collect()
    assert len(rows) == 300 and {r["bulletin"]: r["text"] for r in rows} == {name: f"{text}\n" for name, text in wanted.items()}
    with pytest.raises(AnalysisException):
        readers.bulletins(spark, str(tmp_path / "absent"), partitioned=True).collect()
