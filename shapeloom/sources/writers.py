"""Sinks (K01-K11). Every writer takes any Hadoop URI (local, object store) and
returns what it wrote; none needs a client library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas


def write_manifest(df: DataFrame, output_dir: str, stem: str = "training_manifest",
                   fmt: str = "parquet", partition_by: str | None = None) -> str:
    """``{output_dir}/{stem}.parquet`` (or ``.csv`` with a header)."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"Unsupported manifest format: {fmt}")
    path = f"{output_dir.rstrip('/')}/{stem}.{fmt}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def write_features(df: DataFrame, path: str, partition_by: str | None = None,
                   max_records_per_file: int = 5_000_000) -> str:
    """One feature table (cells, embeddings), not one file per asset."""
    w = df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return path


def write_bucketed(df: DataFrame, table: str, key: str = "uid", buckets: int = 64) -> str:
    """A warehouse table laid out by ``key``; tables of one ``buckets`` join on it without an exchange."""
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return table


def write_keyed(df: DataFrame, path: str, key: str = "uid", parts: int = 256) -> str:
    """Files of which ``readers.read_keyed`` reads only those that requested keys can be in.

    A folder per hash of the key, rows sorted by it inside.
    """
    part = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(parts)).cast("int")
    (df.withColumn("_part", part).repartition(parts, "_part").sortWithinPartitions("_part", key)
     .write.mode("overwrite").partitionBy("_part").parquet(path))
    return path


def write_failures(failures: DataFrame, output_dir: str) -> tuple[str, str]:
    """``failed_assets.csv`` (a folder of part files, each with a header;
    no single-task funnel however many assets fail) and a Parquet copy."""
    f = failures.select(*[F.col(c.name).cast(c.dataType) for c in schemas.FAILURES.fields])
    base = output_dir.rstrip("/")
    f.write.mode("overwrite").option("header", True).csv(f"{base}/failed_assets.csv")
    f.write.mode("overwrite").parquet(f"{base}/failed_assets.parquet")
    return f"{base}/failed_assets.csv", f"{base}/failed_assets.parquet"


def load_table(spark, uri: str, table: str) -> None:
    """Load Parquet into a warehouse table, replacing it (truncate)."""
    spark.read.parquet(uri).write.mode("overwrite").saveAsTable(table)


def materialize(df: DataFrame, name: str, kind: str = "view") -> None:
    """Staging as a view, marts as a table."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        df.write.mode("overwrite").saveAsTable(name)
    else:
        raise ValueError(f"unknown materialization: {kind}")


def write_history(history: DataFrame, path: str) -> str:
    """Epoch metrics as JSON lines."""
    history.coalesce(1).write.mode("overwrite").json(path)
    return path


def append_rows(df: DataFrame, path: str) -> str:
    """Run tables (params, metrics, artifacts, registry), one folder per run.

    Other runs' rows stay; writing a run again replaces its rows, so a rerun
    or a retried job does not double them.
    """
    run = [c for c in ("run_id", "model_id") if c in df.columns][:1]
    w = df.write.option("partitionOverwriteMode", "dynamic")
    (w.mode("overwrite").partitionBy(*run) if run else w.mode("append")).parquet(path)
    return path


def obj_lines(vertices: DataFrame, triangles: DataFrame, key: str = "uid") -> DataFrame:
    """OBJ text per mesh: ``v x y z`` lines then 1-based ``f a b c`` lines.

    Vertex numbers come from a dense per-mesh ordinal, so faces refer to
    vertices by joining on the corner position.
    """
    from ..operators.ordinal import ordinal_within
    v = ordinal_within(vertices.select(key, "x", "y", "z"), [key], ["x", "y", "z"], out="vid", start=1)
    tri = triangles
    for p in "abc":
        vp = v.select(key, F.col("x").alias(f"{p}x"), F.col("y").alias(f"{p}y"), F.col("z").alias(f"{p}z"),
                      F.col("vid").alias(f"v{p}"))
        tri = tri.join(vp, [key, f"{p}x", f"{p}y", f"{p}z"])
    vl = v.select(key, F.lit(0).alias("_k"), F.col("vid").alias("_n"),
                  F.format_string("v %.6f %.6f %.6f", "x", "y", "z").alias("value"))
    fl = tri.select(key, F.lit(1).alias("_k"), F.col("fid").alias("_n"),
                    F.format_string("f %d %d %d", "va", "vb", "vc").alias("value"))
    return vl.unionByName(fl)


def write_obj(vertices: DataFrame, triangles: DataFrame, path: str, key: str = "uid") -> str:
    """One OBJ text file per mesh under ``path/uid=.../``."""
    lines = obj_lines(vertices, triangles, key)
    (lines.repartition(key).sortWithinPartitions(key, "_k", "_n")
     .select(key, "value").write.mode("overwrite").partitionBy(key).text(path))
    return path


MESH_FILES = "filename string, file string, bytes bigint, sha256 string, n_vertices bigint, n_triangles bigint"


def publish_meshes(vertices: DataFrame, triangles: DataFrame, names: DataFrame, path: str, key: str = "request") -> DataFrame:
    """One OBJ file per mesh under its published name; returns the manifest.

    ``vertices`` and ``triangles`` are those of ``surface.dual_surface``,
    ``names`` has one ``filename`` per key. Files go to 256 folders,
    ``path/ab/<filename>`` by the first digits of the name's md5; a task writes
    a file under a temporary name and renames it when it is whole, and the
    manifest, ``path/manifest``, is replaced last: what it names is there.
    A rerun writes the same bytes and replaces. A task holds one mesh's vertex
    numbers at a time. Raises if two keys share a filename.
    """
    import hashlib

    import pyarrow as pa
    from pyarrow import fs
    from pyspark import TaskContext

    named = names.where("filename is not null").select(key, "filename").distinct()
    if not named.groupBy("filename").count().where("count > 1").isEmpty():
        raise ValueError("two meshes share a filename")
    v = vertices.select(key, F.lit(0).alias("kind"), F.array("i", "j", "k").alias("at"), F.array("x", "y", "z").alias("xyz"))
    t = triangles.select(key, F.lit(1).alias("kind"), F.array(*[f"{p}{n}" for p in "abc" for n in "ijk"]).alias("at"),
                         F.array().cast("array<double>").alias("xyz"))
    lines = named.join(v.unionByName(t), key, "left").select("filename", "kind", "at", "xyz")
    lines = lines.repartition("filename").sortWithinPartitions("filename", "kind", "at")
    columns = [c.split() for c in MESH_FILES.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    schema = pa.schema([(n, kinds[k]) for n, k in columns])

    def run(batches):
        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(f"{base}/_open", recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        state = {"name": None}

        def close():
            if state["name"] is None:
                return []
            state["out"].close()
            folder = hashlib.md5(state["name"].encode()).hexdigest()[:2]
            store.create_dir(f"{base}/{folder}", recursive=True)
            store.move(state["open"], f"{base}/{folder}/{state['name']}")
            return [{"filename": state["name"], "file": f"{folder}/{state['name']}", "bytes": state["bytes"],
                     "sha256": state["sha"].hexdigest(), "n_vertices": len(state["ids"]), "n_triangles": state["faces"]}]

        def put(line):
            raw = line.encode()
            state["out"].write(raw)
            state["sha"].update(raw)
            state["bytes"] += len(raw)
        for batch in batches:
            done = []
            for name, kind, at, xyz in zip(*(c.to_pylist() for c in batch.columns)):
                if name != state["name"]:
                    done += close()
                    opened = f"{base}/_open/{hashlib.md5(name.encode()).hexdigest()}.{attempt}"
                    state = {"name": name, "open": opened, "out": store.open_output_stream(opened, compression=None),
                             "sha": hashlib.sha256(), "bytes": 0, "ids": {}, "faces": 0}
                if kind == 0:
                    state["ids"][tuple(at)] = len(state["ids"]) + 1
                    put("v {:.6f} {:.6f} {:.6f}\n".format(*xyz))
                elif kind == 1:
                    state["faces"] += 1
                    put("f {} {} {}\n".format(*(state["ids"][tuple(at[p:p + 3])] for p in (0, 3, 6))))
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if last := close():
            yield pa.RecordBatch.from_pylist(last, schema=schema)
    manifest = lines.mapInArrow(run, MESH_FILES)
    manifest.write.mode("overwrite").parquet(f"{path}/manifest")
    return manifest.sparkSession.read.schema(manifest.schema).parquet(f"{path}/manifest")
