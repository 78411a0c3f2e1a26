"""Zip members, opened one archive per task and streamed in pieces."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmill.sources.lake import qualified

PIECE = 1 << 20
ROWS = 20_000
_GLOB = re.compile(r"[*?\[{]")


def archives(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Archives as bytes. A pattern for the files of one folder is a listing of that folder, not one of every file."""
    files = lambda: spark.read.format("binaryFile")
    folder, _, name = paths.rpartition("/") if isinstance(paths, str) else ("", "", "")
    if not folder or not _GLOB.search(name) or _GLOB.search(folder):
        return files().load(paths).select("path", "content")
    # Files of folders below, which the pattern does not mean, are left out.
    inside = F.col("path") == F.concat(F.lit(f"{qualified(spark, folder)}/"), F.substring_index("path", "/", -1))
    found = files().option("recursiveFileLookup", "true").option("pathGlobFilter", name).load(folder).filter(inside).select("path", "content")
    return files().load(paths).select("path", "content") if not found.select("path").take(1) else found


def _members(batches: Iterator[pd.DataFrame]):
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            yield path, zipfile.ZipFile(io.BytesIO(content))


def _matching(path: str, archive: zipfile.ZipFile, member: str) -> str:
    names = [n for n in archive.namelist() if re.match(member, n)]
    if not names:
        raise FileNotFoundError(f"no member like {member} in {path}")
    return names[0]


def csv_headers(files: DataFrame, member: str, encoding: str) -> DataFrame:
    """Header line of the matching member of each archive."""
    def read(batches):
        for batch in batches:
            found = []
            for path, archive in _members([batch]):
                with archive.open(_matching(path, archive, member)) as f:
                    found.append(f.readline().decode(encoding).strip())
            yield pd.DataFrame({"header": found}, dtype=object)

    return files.mapInPandas(read, "header string")


def _joinable(header: bytes, body: bytes, sep: bytes) -> bool:
    """Whether a table reads the same with rows of others behind it: a header line, no quotes, and as many fields in its first row."""
    first = body.lstrip(b"\r\n").partition(b"\n")[0]
    return bool(header.strip()) and b"\r" not in header.rstrip(b"\r") and b'"' not in header + body and first.count(sep) == header.count(sep)


def csv_rows(files: DataFrame, member: str, columns: list[str], encoding: str, sep: str) -> DataFrame:
    """Rows of the matching member, every column as trimmed text.

    Small tables with the same header line are parsed together, a piece at a time; large ones are streamed.
    """
    def parsed(f):
        for piece in pd.read_csv(f, sep=sep, dtype=str, encoding=encoding, chunksize=ROWS, keep_default_na=False):
            piece.columns = [c.strip() for c in piece.columns]
            piece = piece.reindex(columns=columns).apply(lambda s: s.str.strip())
            yield piece.where(piece.notna() & (piece != ""), None)

    def read(batches):
        held: dict[bytes, list[bytes]] = {}
        size = 0
        together = lambda: (io.BytesIO(b"".join([header, b"\n", *bodies])) for header, bodies in held.items())
        for path, archive in _members(batches):
            name = _matching(path, archive, member)
            if archive.getinfo(name).file_size > PIECE:
                with archive.open(name) as f:
                    yield from parsed(f)
                continue
            text = archive.read(name)
            header, _, body = text.partition(b"\n")
            if not _joinable(header, body, sep.encode(encoding)):
                yield from parsed(io.BytesIO(text))
                continue
            held.setdefault(header, []).extend([body, b"\n"])
            size += len(text)
            if size > PIECE:
                for f in together():
                    yield from parsed(f)
                held, size = {}, 0
        for f in together():
            yield from parsed(f)

    return files.mapInPandas(read, ", ".join(f"`{c}` string" for c in columns))


def xml_fragments(files: DataFrame, tags: list[str]) -> DataFrame:
    """Every element with one of the tags, as text, from single-member archives."""
    pattern = "|".join(re.escape(t) for t in tags)
    opening = re.compile(rf"<({pattern})[\s>]")

    def read(batches):
        for path, archive in _members(batches):
            if len(archive.namelist()) != 1:
                raise OSError(f"{path} must hold one file, it holds {len(archive.namelist())}")
            with io.TextIOWrapper(archive.open(archive.namelist()[0]), encoding="utf-8") as f:
                rest, found = "", []
                while piece := f.read(PIECE):
                    rest += piece
                    while start := opening.search(rest):
                        close = f"</{start.group(1)}>"
                        end = rest.find(close, start.end())
                        if end < 0:
                            break
                        found.append((path, start.group(1), rest[start.start():end + len(close)]))
                        rest = rest[end + len(close):]
                    if not opening.search(rest):
                        # Keep only what could be the beginning of a tag.
                        rest = rest[-max(len(t) for t in tags) - 1:]
                    if found:
                        yield pd.DataFrame(found, columns=["file", "tag", "fragment"])
                        found = []

    return files.mapInPandas(read, "file string, tag string, fragment string")
