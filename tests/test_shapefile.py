"""Shapefile ingest (S08-S10) on sets written by the test helper."""
from shapefile_writer import point_rec, polygon_rec, write_set

from tessera.sources import shapefile as SH


def _make(tmp_path):
    d = tmp_path / "shp"
    d.mkdir()
    fields = [("NAME", "C", 10, 0), ("POP", "N", 8, 0), ("AREA", "N", 10, 3), ("OK", "L", 1, 0),
              ("SINCE", "D", 8, 0), ("NAME", "C", 5, 0)]
    rows = [("Trento", 140, "1.5", "T", "20020101", "a"), ("Bad", "********", "x", "?", "00000000", "b"),
            ("Gone", 1, "2", "F", "20030101", "c")]
    write_set(d, "pts", 1, [point_rec(11.1, 46.0), point_rec(-93.0, 44.9), point_rec(0, 0)],
              (-93.0, 0.0, 11.1, 46.0), fields, rows, deleted=(2,))
    shell = [(0, 0), (0, 4), (4, 4), (4, 0), (0, 0)]          # clockwise shell
    hole = [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]           # counter-clockwise hole
    write_set(d, "poly", 5, [polygon_rec([shell, hole])], (0, 0, 4, 4), [("ID", "N", 4, 0)], [(7,)])
    return d


def test_read_sets_and_types(spark, tmp_path):
    d = _make(tmp_path)
    rows = SH.read_sets(spark, str(d))
    flds = [r.asDict() for r in SH.fields(spark, str(d)).where("stem = 'pts'").collect()]
    assert [f["name"] for f in sorted(flds, key=lambda f: f["position"])] == ["NAME", "POP", "AREA", "OK", "SINCE",
                                                                               "NAME1"]
    pts = SH.typed(rows.where("stem = 'pts'"), flds).orderBy("recno").collect()
    assert len(pts) == 2                                    # deleted record skipped
    a, b = pts
    assert (a.NAME, a.POP, a.AREA, a.OK, str(a.SINCE), a.NAME1) == ("Trento", 140, 1.5, True, "2002-01-01", "a")
    assert (b.POP, b.AREA, b.OK, b.SINCE) == (None, None, None, None)   # null rules
    assert a.geom.kind == "Point" and a.geom.minx == 11.1
    poly = rows.where("stem = 'poly'").first()
    assert poly.geom.kind == "Polygon" and len(poly.geom.parts[0]) == 2  # shell + hole


def test_header_stats(spark, tmp_path):
    d = _make(tmp_path)
    st = {r.stem: r for r in SH.header_stats(spark, str(d)).collect()}
    assert st["pts"]["count"] == 3 and st["pts"].shape_type == 1 and st["pts"].minx == -93.0
    assert st["poly"].maxx == 4.0


def test_sets_of_one_name_in_two_folders(spark, tmp_path):
    for sub, pop in (("a", 1), ("b", 2)):
        (tmp_path / sub).mkdir()
        write_set(tmp_path / sub, "same", 5, [polygon_rec([[(0, 0), (0, pop), (pop, pop), (0, 0)]])], (0, 0, pop, pop), [("ID", "N", 4, 0)], [(pop,)])
    got = {(r["stem"], r["geom"]["maxx"], r["attributes"]["ID"]) for r in SH.read_sets(spark, str(tmp_path)).collect()}
    assert got == {("a/same", 1.0, "1"), ("b/same", 2.0, "2")}
    assert {(r["stem"], r["count"], r["maxx"]) for r in SH.header_stats(spark, str(tmp_path)).collect()} == {("a/same", 1, 1.0), ("b/same", 1, 2.0)}
