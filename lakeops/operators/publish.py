"""Publication of staged files into a lake table (ING-1..ING-3, SNK-3).

A load never writes into its target.  It writes beside it, checks what it wrote, and then
puts a small *publication record* beside the tables, which says what is to move where.
From then on the load is decided: whoever finds the record (the load itself, or the next
call after a lost driver) carries out what is left of it, and the record goes last.
Before that, a failing extract leaves only a stage that nothing refers to.

Kinds of publication, each made of steps that can be repeated:

* ``replace``: the stage becomes the target; the old folder goes;
* ``append``: the stage's files move into the target, below their partitions;
* ``swap``: whole partition folders of the stage take the place of those in the target, and
  partition folders that hold nothing any more go;
* ``rewrite``: for catalog tables whose files cannot simply be moved (new, bucketed, of another
  format, or with other columns than before): written by Spark from the stage.

Catalog tables keep their location, type, comment and properties: files move below the
table's location, and the partitions that a publication wrote are added to the catalog, no
others.  ``note`` is whatever the load wants to remember; it is handed to ``done`` when the
files are in place and before the record goes, so it is told at least once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import types as T

REPLACE, APPEND, SWAP, REWRITE = "replace", "append", "swap", "rewrite"
_NULL = "__HIVE_DEFAULT_PARTITION__"
# Partitions that one ALTER TABLE adds.
_ADDED_AT_ONCE = 100


@dataclass
class Publication:
    kind: str
    table: str
    target: str                 # folder of the table
    stage: str                  # folder beside it, complete and checked
    partition_by: list[str] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)   # partition folders that the stage brings, below the target
    gone: list[str] = field(default_factory=list)    # partition folders that end up without rows
    rewrite: dict | None = None  # what a catalog table is written by: schema, provider, location, comment, properties
    note: dict | None = None
    id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])


Done = Callable[[dict], None]
Watch = Callable[[str, str], None]


class Files:
    """The few file operations a publication needs, on any Hadoop file system."""

    def __init__(self, spark: SparkSession):
        self.spark, self._jvm = spark, spark.sparkContext._jvm

    def at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self.at(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        fs, p = self.at(path)
        if not fs.delete(p, True) and fs.exists(p):
            raise OSError(f"could not delete {path}")

    def rename(self, old: str, new: str) -> None:
        fs, p = self.at(old)
        to = self.at(new)[1]
        fs.mkdirs(to.getParent())
        if not fs.rename(p, to):
            raise OSError(f"could not rename {old} to {new}")

    def read(self, path: str) -> str | None:
        fs, p = self.at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """All of ``text`` or nothing: written beside ``path``, then renamed."""
        fs, p = self.at(path)
        beside = self.at(f"{path}.{uuid.uuid4().hex[:8]}.tmp")[1]
        stream = fs.create(beside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not fs.rename(beside, p):
            raise OSError(f"could not write {path}")

    def folders(self, path: str, depth: int) -> Iterator[str]:
        """Partition folders ``depth`` levels below ``path``, relative to it."""
        fs, p = self.at(path)
        if depth == 0:
            yield ""
            return
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and "=" in name and not name.startswith(("_", ".")):
                for below in self.folders(f"{path}/{name}", depth - 1):
                    yield f"{name}/{below}" if below else name

    def data_files(self, path: str) -> Iterator[tuple[str, int]]:
        """``(file below path, length)``, hidden and marker files left out."""
        fs, p = self.at(path)
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if st.isDirectory():
                for below, length in self.data_files(f"{path}/{name}"):
                    yield f"{name}/{below}", length
            else:
                yield name, st.getLen()

    def length(self, path: str) -> int:
        fs, p = self.at(path)
        return fs.getFileStatus(p).getLen()


def record_path(home: str, table: str) -> str:
    return f"{home}/_publish/{table}.json"


def stage_path(home: str, table: str) -> str:
    """A fresh folder on the target's own file system, hidden from readers of the lake."""
    return f"{home}/_publish/{table}-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, home: str, what: Publication, catalog_name: str | None = None,
            done: Done | None = None, watch: Watch | None = None) -> None:
    """Decide a publication by its record and carry it out."""
    files = Files(spark)
    path = record_path(home, what.table)
    if files.exists(path):
        raise RuntimeError(f"{what.table} has an unfinished publication; finish it first")
    files.write(path, json.dumps(asdict(what), default=str))
    _carry_out(files, home, what, catalog_name, done, watch)


def finish(spark: SparkSession, home: str, table: str, catalog_name: str | None = None,
           done: Done | None = None, watch: Watch | None = None) -> Publication | None:
    """Carry out what is left of a table's publication, if one was interrupted."""
    files = Files(spark)
    text = files.read(record_path(home, table))
    if text is None:
        return None
    what = Publication(**json.loads(text))
    _carry_out(files, home, what, catalog_name, done, watch)
    return what


def _carry_out(files: Files, home: str, what: Publication, catalog_name: str | None, done: Done | None,
               watch: Watch | None) -> None:
    told = (lambda step: watch(what.table, step)) if watch else (lambda step: None)
    if what.kind == REWRITE:
        told("rewrite")
        _rewrite(files, catalog_name, what)
    else:
        {REPLACE: _replace, APPEND: _append, SWAP: _swap}[what.kind](files, what, told)
    if catalog_name:
        told("catalog")
        if what.kind != REWRITE:
            _register(files.spark, catalog_name, what)
        files.spark.catalog.refreshTable(catalog_name)
    else:
        files.spark.catalog.refreshByPath(what.target)
    told("note")
    if done and what.note is not None:
        done(what.note)
    told("record")
    files.delete(record_path(home, what.table))
    for left in (what.stage, f"{what.stage}-old"):
        files.delete(left)


def _take_place(files: Files, new: str, place: str, old: str) -> None:
    """``new`` comes to ``place``; what was there goes to ``old``.  Repeatable: ``new`` exists until the last step."""
    if not files.exists(new):
        return
    if files.exists(place):
        if files.exists(old):  # a rename that a store had to make by copying was cut off: the stage is whole
            files.delete(place)
        else:
            files.rename(place, old)
    files.rename(new, place)


def _replace(files: Files, what: Publication, told) -> None:
    told("replace")
    _take_place(files, what.stage, what.target, f"{what.stage}-old")


def _append(files: Files, what: Publication, told) -> None:
    if not files.exists(what.stage):
        return
    for name, length in list(files.data_files(what.stage)):
        told(f"append {name}")
        to = f"{what.target}/{name}"
        # File names are unique, so a file of that name is an earlier attempt's: whole, or cut off.
        if files.exists(to):
            if files.length(to) == length:
                continue
            files.delete(to)
        files.rename(f"{what.stage}/{name}", to)


def _swap(files: Files, what: Publication, told) -> None:
    for part in what.parts:
        told(f"swap {part}")
        _take_place(files, f"{what.stage}/{part}", f"{what.target}/{part}", f"{what.stage}-old/{part}")
    for part in what.gone:
        told(f"remove {part}")
        files.delete(f"{what.target}/{part}")


# ------------------------------------------------------------------ catalog
def _spec(part: str) -> str:
    """``a=1/b=x`` as ``a='1', b='x'``."""
    pairs = []
    for level in part.split("/"):
        name, value = level.split("=", 1)
        value = unquote(value)
        shown = "null" if value == _NULL else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        pairs.append(f"`{unquote(name)}`={shown}")
    return ", ".join(pairs)


def _register(spark: SparkSession, name: str, what: Publication) -> None:
    """Tell the catalog of the partitions that were written, and of those that went."""
    if what.partition_by:
        gone = what.gone
        if what.kind == REPLACE:  # the whole folder is new
            gone = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect() if r[0] not in set(what.parts)]
        for part in gone:
            where = _partition_location(spark, name, part)
            # A partition that the catalog has under another folder's spelling stays.
            if where is not None and where.rstrip("/").endswith("/" + part):
                spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_spec(part)})")
        for i in range(0, len(what.parts), _ADDED_AT_ONCE):
            added = " ".join(f"PARTITION ({_spec(p)})" for p in what.parts[i:i + _ADDED_AT_ONCE])
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")


def _rewrite(files: Files, name: str, what: Publication) -> None:
    """Write a catalog table from the stage; its provider, place, comment and properties stay."""
    if not files.exists(what.stage):
        return
    how = what.rewrite
    # A session of its own: how partitions are overwritten is a setting of the session, which others share.
    spark = files.spark.newSession()
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    schema = T.StructType.fromJson(json.loads(how["schema"]))
    rows = spark.read.schema(schema).parquet(what.stage)
    if how["insert"]:
        rows.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
        return
    writer = rows.write.mode("overwrite").format(how["provider"])
    if what.partition_by:
        writer = writer.partitionBy(*what.partition_by)
    if how["location"]:  # an external table stays one, at its place
        writer = writer.option("path", how["location"])
    writer.saveAsTable(name)
    quoted = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if how["properties"]:
        told = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in how["properties"].items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({told})")
    if how["comment"]:
        spark.sql(f"COMMENT ON TABLE {name} IS {quoted(how['comment'])}")


def _partition_location(spark: SparkSession, name: str, part: str) -> str | None:
    try:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({_spec(part)})").collect()
    except Exception:  # noqa: BLE001 - no such partition
        return None
    found = [r["data_type"] for r in rows if r["col_name"] == "Location"]
    return unquote(found[0]) if found else None
