"""Tables made of parts, of which one commit replaces any number at once.

A part is a folder of rows, such as a month's. The state of a table is a small list of which
folder holds which part; states are numbered, and the newest is the table. A commit writes its
new folders beside the old ones and then adds the next state in one step that fails if someone else was
faster. So a reader sees all of a commit or nothing, and of two writers that began with the
same state one fails and leaves the table as it is.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tiermart.sinks import tables

STATES = "_states"


class Conflict(RuntimeError):
    """Another writer committed first."""


@dataclass(frozen=True)
class State:
    """Folder of each part below the table's root, and what else was noted with the commit."""

    number: int = 0
    parts: Mapping[str, str] = field(default_factory=dict)
    notes: Mapping[str, int | str] = field(default_factory=dict)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(name) for name in tables.names_in(spark, f"{root}/{STATES}") if name.isdigit())


def read_state(spark: SparkSession, root: str, number: int | None = None) -> State:
    """The newest state of the table at ``root``, or the given one; number 0 if there is none."""
    found = _numbers(spark, root) if number is None else [number]
    if not found:
        return State()
    text = spark.read.text(f"{root}/{STATES}/{found[-1]}", wholetext=True).first()[0]
    return State(found[-1], **json.loads(text))


def commit(spark: SparkSession, root: str, base: State, changes: Mapping[str, str | None], notes: Mapping[str, int | str] = {}) -> State:  # noqa: B006
    """The state after ``base`` with some parts replaced, or removed where None stands for a folder."""
    parts = {name: folder for name, folder in {**base.parts, **changes}.items() if folder is not None}
    state = State(base.number + 1, parts, {**base.notes, **notes})
    text = json.dumps({"parts": dict(sorted(parts.items())), "notes": dict(state.notes)})
    jvm = spark._jvm
    draft, target = (jvm.org.apache.hadoop.fs.Path(f"{root}/{STATES}/{name}") for name in (f"draft-{uuid.uuid4().hex}", state.number))
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    stream = draft.getFileSystem(conf).create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), conf)
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(draft, target, options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception.getClass()):
            raise
        draft.getFileSystem(conf).delete(draft, False)
        raise Conflict(f"{root} has a newer state than {base.number}") from error
    return state


def write_parts(df: DataFrame, root: str, name: Callable[[str], str], column: str) -> tuple[dict[str, str], int]:
    """Write the rows of ``df``, one folder for each value of ``column``; the folder of each part, and the rows.

    Nothing is committed yet. ``name`` makes a part's name of a value as text. The column stays in the rows.
    """
    spark = df.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    seen = Observation()
    rows = df.withColumn("_part", F.col(column)).hint("rebalance", "_part").observe(seen, F.count(F.lit(1)).alias("n"))
    rows.write.partitionBy("_part").parquet(f"{root}/{folder}")
    values = [n.removeprefix("_part=") for n in tables.names_in(spark, f"{root}/{folder}") if n.startswith("_part=")]
    return {name(value): f"{folder}/_part={value}" for value in values}, seen.get["n"]


def open_parts(spark: SparkSession, root: str, state: State, wanted: Callable[[str], bool] = lambda name: True) -> DataFrame | None:
    """The rows of the parts whose name is wanted; None if there are none."""
    paths = [f"{root}/{folder}" for name, folder in sorted(state.parts.items()) if wanted(name)]
    return spark.read.parquet(*paths) if paths else None


def drop_old_states(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Forget all but the newest ``keep`` states and remove the folders that only those held; returns how many."""
    numbers = _numbers(spark, root)
    old, new = numbers[: -max(keep, 1)], numbers[-max(keep, 1) :]

    def folders(numbers: Iterable[int]) -> set[str]:
        return {folder for n in numbers for folder in read_state(spark, root, n).parts.values()}

    gone = folders(old) - folders(new)
    for folder in gone:
        tables.delete_folder(spark, f"{root}/{folder}")
    for n in old:
        tables.delete_folder(spark, f"{root}/{STATES}/{n}")
    return len(gone)
