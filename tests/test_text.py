"""Text operators against the golden rows (FIXTURES §3) and hostile inputs."""

from pyspark.sql import functions as F

from shapeloom import schemas
from shapeloom.functions import text as tx
from shapeloom.operators import catalog as cat

NB = " "


def T(*names):
    return [None if n is None else {"name": n} for n in names]


GOLDEN = [
    ("a1", "Oak_Chair-01", None, T("wood", "3D", "Wood", "free"), T("furniture-home"),
     "Oak Chair 01 wood Wood furniture home", "oak chair 01 wood wood furniture home"),
    ("a2", "550e8400e29b41d4a716446655440000", "", None, None, "chair furniture", "chair furniture"),
    ("a3", "550e8400-e29b-41d4-a716-446655440000", None, [], [],
     "550e8400 e29b 41d4 a716", "550e8400 e29b 41d4 a716"),
    ("a4", "Sat, 15 Jun 2019 18:32:10", "Design Gallery", [None, {"name": "ab1"}, {"name": "stool"}],
     T("stool"), "stool", "stool"),
    ("a5", "Nice chair", "See https://my-site.com/x-y now. Please  follow me for more", T("seat"), None,
     "Nice chair See site.com/x y now.", "nice chair see site com x y now"),
    ("a6", "Facebook chair", None, None, None, "chair furniture", "chair furniture"),
    ("a7", NB + "椅子です  チェア", "Étagère d’été", T("Unreal", "Blender"), T("blender"),
     "椅子です チェア Étagère d’été blender", "tag re d t blender"),
    ("a8", "chair", "chair", T("chair", "Chair"), T("chair"), "chair Chair", "chair chair"),
    ("a9", "long", " ".join(f"w{i}ord" for i in range(60)), None, None,
     "long " + " ".join(f"w{i}ord" for i in range(34)), "long " + " ".join(f"w{i}ord" for i in range(34))),
    ("a10", None, None, None, None, "chair furniture", "chair furniture"),
    ("a11", "12 34", "deadbeef0123456789 arm rest", [None], None, "arm rest", "arm rest"),
    ("a12", "Newfields_Design-Gallery", "WWW.SHOP.COM/a_b seat", T("substance-painter"), None,
     "b seat", "b seat"),
]


def _annotations(spark):
    rows = [(u, n, d, t, c) for u, n, d, t, c, _, _ in GOLDEN]
    return spark.createDataFrame(rows, schemas.ANNOTATIONS)


def test_clean_description_reference_case(spark):
    df = spark.createDataFrame([("  Modern, RED chair!! ",)], "t string")
    assert df.select(tx.clean_description("t")).first()[0] == "modern red chair"


def test_build_description_golden(spark):
    ann = _annotations(spark)
    members = ann.select(F.lit("chair").alias("category"), F.lit(0).cast("long").alias("pos"), "uid")
    out = {r.uid: r.description_raw for r in cat.category_metadata(members, ann).collect()}
    for u, *_, raw, _ in GOLDEN:
        assert out[u] == raw, u


def test_clean_manifest_golden(spark):
    ann = _annotations(spark)
    members = ann.select(F.lit("chair").alias("category"), F.lit(0).cast("long").alias("pos"), "uid")
    out = {r.uid: r.description for r in cat.clean_manifest(cat.category_metadata(members, ann)).collect()}
    for u, *_, clean in GOLDEN:
        assert out[u] == clean, u


def test_missing_annotation_gets_fallback(spark):
    ann = _annotations(spark).where("uid = 'a1'")
    members = spark.createDataFrame([("chair", 0, "a1"), ("chair", 1, "zz")], "category string, pos long, uid string")
    out = {r.uid: r.description_raw for r in cat.category_metadata(members, ann).collect()}
    assert out["zz"] == "chair furniture"


def test_is_useful_text_probes(spark):
    probes = {
        "550e8400-e29b-41d4-a716-446655440000": True,
        "550e8400e29b41d4a716446655440000": False,
        "Sat, 15 Jun 2019 18:32:10": False,
        "sat 15 jun 2019": False,
        "15 jun 2019": True,
        "Design_Gallery": False,
        "3d": False,
        "ab1": False,
        "abc": True,
        "counterrevolutionaryfacade": True,
        "décadéfacadebeadcab": False,
        "": False,
        None: False,
        NB + NB: False,
    }
    df = spark.createDataFrame([(k,) for k in probes], "t string")
    got = {r.t: r.u for r in df.select("t", tx.is_useful_text("t").alias("u")).collect()}
    for k, v in probes.items():
        assert got[k] == v, k


def test_clean_text_idempotent_and_whitespace(spark):
    df = spark.createDataFrame([("a-b_c 　d\n\te  ",), (None,), ("x",)], "t string")
    r = df.select(tx.clean_text("t").alias("c"), tx.clean_text(tx.clean_text("t")).alias("cc")).collect()
    assert r[0].c == "a b c d e" and r[1].c == "" and all(x.c == x.cc for x in r)


def test_sanitize_promo_order_and_hex(spark):
    rows = [("x follow and support me", "c"), ("support me please follow", "c"),
            ("id deadbeefcafe0001 keep", "c"), ("édeadbeefcafe0001 keep", "c"), ("   ", "lamp")]
    df = spark.createDataFrame(rows, "t string, c string")
    got = [r[0] for r in df.select(tx.sanitize_description("t", "c")).collect()]
    assert got == ["x", "c furniture", "id keep", "édeadbeefcafe0001 keep", "lamp furniture"]


def test_build_description_never_empty(spark):
    # The second fallback is unreachable, the builder never returns ''
    df = spark.createDataFrame([(None, None, None, None, "c"), ("", "!!", [], [], None)],
                               "n string, d string, t array<struct<name:string>>, "
                               "k array<struct<name:string>>, cat string")
    got = [r[0] for r in df.select(tx.build_description("n", "d", "t", "k", "cat")).collect()]
    assert got == ["c furniture", "None furniture"]


def test_tokenize_slug_paths(spark):
    df = spark.createDataFrame([("A wooden-Chair!", "/a/b/000-001/x.glb.glb", "--Hello, World--")],
                               "t string, p string, s string")
    r = df.select(tx.tokenize("t").alias("tok"), tx.tokenize(F.lit("")).alias("e"), tx.path_stem("p").alias("st"),
                  tx.strip_shard("p").alias("sh"), tx.slug("s").alias("sl"), tx.slug(F.lit("!!")).alias("s2"),
                  tx.slug(F.lit("a" * 39 + "-b")).alias("s3")).first()
    assert r.tok == ["a", "wooden-chair"] and r.e == ["empty"]
    assert r.st == "x" and r.sh == "/a/b/x.glb.glb" and r.sl == "hello-world" and r.s2 == "shape"
    assert r.s3 == "a" * 39 + "-"


def test_notebook_steps_are_worked_out_once(spark):
    rows = [("a", T("The (red) chair!", "of oak")), ("b", T("the", "OF.")), ("c", T(None, "...")), ("d", []), ("e", None), ("f", T(NB + "[x]" + NB, "^y_`{|}~"))]
    df = spark.createDataFrame(rows, "uid string, tags array<struct<name:string>>")
    out = cat.notebook_descriptions(df, stop_words=["the", "of"])
    assert {r.uid: r.description for r in out.collect()} == {"a": "the red chair oak", "b": "of", "f": "x y"}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(") == plan.count("array_join(transform(") == 1
