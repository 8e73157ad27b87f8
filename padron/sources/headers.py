"""Headers of many files, found by one job.

Each task opens its share of the listed files and reads no more than their first line; the driver
gets one row per monthly source and header variant, never one per file, unless the files of a
source differ.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.sources.catalog import FILE_PATTERN


def with_headers(files: DataFrame, sep: str = "|", encoding: str = "ISO-8859-1") -> DataFrame:
    """Adds `header` to listed files (column `path`): the names in the first line that is not blank.

    It is null for a file without such a line. A name left blank is `_c` and its number, and names
    that repeat carry their numbers, as Spark names them. Files are opened by Arrow, in any store
    that it knows; a file that cannot be opened is an error that names it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All that a worker needs is in here, so that it need not have the package.
        import csv
        from collections import Counter
        from urllib.parse import quote

        import pyarrow
        from pyarrow import fs

        def open_file(path: str):
            scheme, _, rest = path.partition(":")
            if scheme == "file" or not rest:
                return fs.LocalFileSystem().open_input_stream("/" + (rest or path).lstrip("/"))
            store, inside = fs.FileSystem.from_uri(quote(path, safe=":/=@%"))
            return store.open_input_stream(inside)

        def header(path: str) -> list[str] | None:
            rest = b""
            try:
                with open_file(path) as stream:
                    while chunk := stream.read(65_536):
                        lines = (rest + chunk).replace(b"\r\n", b"\n").split(b"\n")
                        rest = lines.pop()
                        if full := next((x for x in lines if x.strip()), None):
                            return names(full)
            except OSError as error:
                raise OSError(f"could not read the header of {path}: {error}") from error
            return names(rest) if rest.strip() else None

        def names(line: bytes) -> list[str]:
            fields = next(csv.reader([line.decode(encoding)], delimiter=sep))
            repeats = Counter(f.lower() for f in fields)
            return [f"_c{i}" if not f else f"{f}{i}" if repeats[f.lower()] > 1 else f
                    for i, f in enumerate(fields)]

        for batch in batches:
            found = [header(p) for p in batch.column("path").to_pylist()]
            yield pyarrow.RecordBatch.from_arrays(
                [*batch.columns, pyarrow.array(found, pyarrow.list_(pyarrow.string()))],
                [*batch.schema.names, "header"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    return files.mapInArrow(run, f"{kinds}, header array<string>")


def header_variants(files: DataFrame, whole_sources: bool) -> dict[tuple[str, ...], list[str]]:
    """Paths to read by header; files without a header are left out.

    With `whole_sources` the files are all files of their sources, and a source whose files agree
    is one path: its folder. Otherwise, and for a source whose files differ, each file is a path.
    """
    source = F.regexp_replace("path", "(" + FILE_PATTERN + ")/.*$", "$1")
    known = with_headers(files.select("path")).filter(F.col("header").isNotNull())
    variants = known.withColumn("source", source).groupBy("source", "header").agg(
        F.collect_list("path").alias("paths"))
    agreed = (F.size("of_source") == 1) & F.lit(whole_sources)
    rows = variants.groupBy("source").agg(
        F.collect_list(F.struct("header", "paths")).alias("of_source")).select(
        F.explode(F.transform("of_source", lambda v: F.struct(
            v["header"].alias("header"),
            F.when(agreed, F.array("source")).otherwise(v["paths"]).alias("paths")))).alias("v"))
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in rows.select("v.*").collect():
        groups.setdefault(tuple(row.header), []).extend(row.paths)
    return {header: sorted(paths) for header, paths in sorted(groups.items())}
