"""A stream of text lines whose offsets count records, for bounded reads.

Spark's file stream bounds a batch by files. This source bounds it by lines: an offset is the number
of lines read so far together with the file and byte where the next one begins, so each batch takes
exactly as many lines as it may, a restart goes on at the next line, and nothing is counted twice.

Files are read in the order of their names and must not change once they are there; new ones come
behind, as rolled logs do. A last line counts with or without its line end. On the driver only the
lines of the coming batch are looked at, to find where it ends; the lines themselves are read by
tasks, a range of bytes each. Paths are those of pyarrow's file systems.

The class is made inside a function so that Spark ships it by value: tasks need no package of ours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FORMAT = "counted_lines"
SCHEMA = "value STRING, record BIGINT"
#: Lines are counted in blocks of so many bytes, and a task reads about that much.
BLOCK_BYTES = 8 << 20


def _source() -> type:
    import pyarrow as pa
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    class Range(InputPartition):
        def __init__(self, file: str, begin: int, end: int, record: int):
            self.file, self.begin, self.end, self.record = file, begin, end, record

    class Reader(DataSourceStreamReader):
        def __init__(self, path: str, batch: int, run: int, block: int):
            self.path, self.batch, self.run, self.block = path, batch, run, block
            self.position: dict | None = None  # where the next batch begins, once it is known
            self.began: int | None = None  # the record count at the start of this run
            self.ranges: dict[str, list[Range]] = {}

        def _files(self) -> list[tuple[str, int]]:
            from pyarrow import fs

            system, root = fs.FileSystem.from_uri(self.path)
            found = system.get_file_info(fs.FileSelector(root, recursive=False))
            names = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_")))
            return [(name, size) for name, size in names if size]

        def _open(self, file: str):
            from pyarrow import fs

            return fs.FileSystem.from_uri(self.path)[0].open_input_file(file)

        def _advance(self, start: dict, lines: int) -> tuple[dict, list[Range]]:
            """The offset ``lines`` further on, or at the end of what is there, and the ranges between."""
            at, ranges, left = dict(start), [], lines
            for file, size in self._files():
                if not left:
                    break
                if file < at["file"] or (file == at["file"] and at["byte"] >= size):
                    continue
                begin = at["byte"] if file == at["file"] else 0
                with self._open(file) as source:
                    while begin < size and left:
                        end, found = self._lines(source, begin, size, left)
                        ranges.append(Range(file, begin, end, at["records"]))
                        at = {"records": at["records"] + found, "file": file, "byte": end}
                        begin, left = end, left - found
            return at, ranges

        def _lines(self, source, begin: int, size: int, most: int) -> tuple[int, int]:
            """End and number of the whole lines from ``begin`` on: a block's worth, one at least, ``most`` at most."""
            source.seek(begin)
            block = source.read(self.block)
            while b"\n" not in block and begin + len(block) < size:
                block += source.read(self.block)
            if begin + len(block) >= size and not block.endswith(b"\n"):
                whole, found = len(block), block.count(b"\n") + 1
            else:
                whole = block.rfind(b"\n") + 1
                found = block.count(b"\n", 0, whole)
            if found <= most:
                return begin + whole, found
            end = 0
            for _ in range(most):
                end = block.index(b"\n", end) + 1
            return begin + end, most

        def initialOffset(self) -> dict:
            return {"records": 0, "file": "", "byte": 0}

        def latestOffset(self) -> dict:
            if self.position is None:
                self.position = self.initialOffset()
            if self.began is None:
                self.began = self.position["records"]
            wanted = self.batch
            if self.run:
                wanted = min(wanted or self.run, self.began + self.run - self.position["records"])
            end, ranges = self._advance(self.position, max(0, wanted))
            self.ranges[str(end["records"])] = ranges
            self.position = end
            return end

        def partitions(self, start: dict, end: dict) -> list[Range]:
            # After a restart Spark asks for the last batch before it asks for new lines.
            if self.position is None or end["records"] > self.position["records"]:
                self.position = end
            planned = self.ranges.pop(str(end["records"]), None)
            if planned is not None and planned and planned[0].record == start["records"]:
                return planned
            return self._advance(start, end["records"] - start["records"])[1]

        def read(self, partition: Range):
            with self._open(partition.file) as source:
                source.seek(partition.begin)
                text = source.read(partition.end - partition.begin)
            lines = text.removesuffix(b"\n").split(b"\n")
            values = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
            numbers = range(partition.record + 1, partition.record + len(values) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array(numbers, pa.int64())], names=["value", "record"])

        def commit(self, end: dict) -> None:
            pass

    class Lines(DataSource):
        @classmethod
        def name(cls) -> str:
            return "counted_lines"

        def schema(self) -> str:
            return "value STRING, record BIGINT"

        def streamReader(self, schema):
            number = {name: int(self.options.get(name, "0")) for name in ("batch", "run", "block")}
            return Reader(self.options["path"], number["batch"], number["run"], number["block"])

    return Lines


def read_lines(spark: SparkSession, path: str, per_batch: int, per_run: int | None = None) -> DataFrame:
    """Stream of (value, record): at most ``per_batch`` lines a batch and, if given, ``per_run`` in a run."""
    if per_batch < 1 or (per_run is not None and per_run < 1):
        raise ValueError("a bound must be at least one line")
    spark.dataSource.register(_source())
    options = {"batch": per_batch, "run": per_run or 0, "block": BLOCK_BYTES}
    return spark.readStream.format(FORMAT).options(**{k: str(v) for k, v in options.items()}).load(path)
