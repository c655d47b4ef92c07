"""Files, directories, archives, media tags and directory comparison.

Listings run on executors that can read the folder (``binaryFile`` with its metadata),
so a store of many files is scanned in parallel; contents are read only by queries that
name them.
"""

from __future__ import annotations

import io
import os
import tarfile
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .basic import empty, exists
from .registry import Registry, TableFunction

ENTRY = "CompressionType string, ArchivedTime timestamp, CompressedSize bigint, Crc bigint, CreatedTime timestamp, Key string, LinkTarget string, IsDirectory boolean, IsEncrypted boolean, IsSplitAfter boolean, IsSolid boolean, VolumeIndexFirst int, VolumeIndexLast int, LastAccessedTime timestamp, LastModifiedTime timestamp, Size bigint, Attrib int, Content binary"
ZIP = "Name string, FullName string, CompressedLength bigint, LastWriteTime timestamp, Length bigint, IsDirectory boolean, Level int, Content binary"
FILE = "Name string, FileName string, CreationTime timestamp, CreationTimeUtc timestamp, LastAccessTime timestamp, LastAccessTimeUtc timestamp, LastWriteTime timestamp, LastWriteTimeUtc timestamp, DirectoryName string, DirectoryPath string, Extension string, FullPath string, Exists boolean, IsReadOnly boolean, Length bigint, Root string, Attributes bigint, Content binary, Metadata array<struct<DirectoryName:string,TagName:string,Description:string>>"
DIRECTORY = "FullName string, DirectoryPath string, Attributes bigint, CreationTime timestamp, CreationTimeUtc timestamp, LastAccessTime timestamp, LastAccessTimeUtc timestamp, LastWriteTime timestamp, LastWriteTimeUtc timestamp, Exists boolean, Extension string, Name string, Parent struct<FullName:string,Name:string>, Root string"
TAG = "FullName string, DirectoryName string, TagName string, Description string"


def _binary(engine, path: str, recursive: bool) -> DataFrame:
    return engine.spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)


def _bare(path: Column) -> Column:
    """A path without its scheme, where it is a local one."""
    return F.url_decode(F.regexp_replace(F.regexp_replace(path, r"\+", "%2B"), r"^file:(//)?", ""))


def files(engine, directory: str, recursive: bool) -> DataFrame:
    """Files below a directory. Stores keep one time for a file; it stands for creation, access and writing."""
    if not exists(engine, directory):
        return empty(engine, FILE)
    path = _bare(F.col("path"))
    name, folder = F.substring_index(path, "/", -1), F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    time = F.col("modificationTime")
    return _binary(engine, directory, bool(recursive)).select(
        name.alias("Name"), name.alias("FileName"), *[time.alias(t) for t in ("CreationTime", "CreationTimeUtc", "LastAccessTime", "LastAccessTimeUtc", "LastWriteTime", "LastWriteTimeUtc")],
        F.substring_index(folder, "/", -1).alias("DirectoryName"), folder.alias("DirectoryPath"), F.regexp_extract(path, r"(\.[^./]*)$", 1).alias("Extension"), path.alias("FullPath"),
        F.lit(True).alias("Exists"), F.lit(False).alias("IsReadOnly"), F.col("length").alias("Length"), F.lit(os.path.abspath(directory) if "://" not in directory else directory).alias("Root"), F.lit(128).cast("bigint").alias("Attributes"), F.col("content").alias("Content"), tags_of(F.col("path"), F.col("content")).alias("Metadata"),
    )


def directories(engine, directory: str, recursive: bool) -> DataFrame:
    """Directories below a directory, listed by the driver's file system client; unreadable ones are skipped."""
    jvm = engine.spark._jvm.org.apache.hadoop.fs
    start = jvm.Path(directory)
    system = start.getFileSystem(engine.spark._jsc.hadoopConfiguration())
    rows, waiting = [], [start]
    while waiting:
        here = waiting.pop()
        try:
            found = system.listStatus(here)
        except Exception:  # noqa: BLE001
            continue
        for s in found:
            if s.isDirectory():
                full = s.getPath().toUri().getPath()
                parent = os.path.dirname(full)
                when = pd.Timestamp(s.getModificationTime(), unit="ms").to_pydatetime()
                rows.append((full, full, 16, *[when] * 6, True, os.path.splitext(full)[1], os.path.basename(full), (parent, os.path.basename(parent)), "/"))
                if recursive:
                    waiting.append(s.getPath())
    return engine.spark.createDataFrame(rows, DIRECTORY)


def _stamp(parts) -> pd.Timestamp | None:
    try:
        return pd.Timestamp(*parts)
    except ValueError:
        return None


def zip_rows(data: bytes):
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for i in z.infolist():
            yield i, (lambda i=i: z.read(i))


def archive_entries(data: bytes):
    """Entries of a zip or tar archive as rows of ``ENTRY``."""
    if zipfile.is_zipfile(io.BytesIO(data)):
        for i, read in zip_rows(data):
            kind = {zipfile.ZIP_STORED: "None", zipfile.ZIP_DEFLATED: "Deflate", zipfile.ZIP_BZIP2: "BZip2", zipfile.ZIP_LZMA: "LZMA"}.get(i.compress_type, "Unknown")
            yield (kind, None, i.compress_size, i.CRC, None, i.filename, None, i.is_dir(), bool(i.flag_bits & 1), False, False, 0, 0, None, _stamp(i.date_time), i.file_size, i.external_attr >> 16, None if i.is_dir() else read())
        return
    with tarfile.open(fileobj=io.BytesIO(data)) as t:
        for m in t:
            body = t.extractfile(m).read() if m.isfile() else None
            yield ("None", None, m.size, 0, None, m.name, m.linkname or None, m.isdir(), False, False, False, 0, 0, None, pd.Timestamp(m.mtime, unit="s"), m.size, m.mode, body)


def _columns(ddl: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in ddl.split(", ")]


def _expand(rows_of, ddl: str):
    names = _columns(ddl)

    def run(batches):
        for batch in batches:
            for data in batch["content"]:
                rows = list(rows_of(data))
                if rows:
                    yield pd.DataFrame(rows, columns=names, dtype=object)

    return run


def archive(engine, path: str) -> DataFrame:
    return _binary(engine, path, False).select("content").mapInPandas(_expand(archive_entries, ENTRY), ENTRY)


def zip_listing(engine, path: str) -> DataFrame:
    """Entries of zip files, directories left out."""

    def rows(data):
        for i, read in zip_rows(data):
            if not i.is_dir():
                yield (os.path.basename(i.filename), i.filename, i.compress_size, _stamp(i.date_time), i.file_size, False, i.filename.count("/"), read())

    return _binary(engine, path, False).select("content").mapInPandas(_expand(rows, ZIP), ZIP)


def compare(engine, source: str, destination: str) -> DataFrame:
    """A full outer join of two directories by relative path; states by content hash."""

    def side(path: str, name: str) -> DataFrame:
        df = files(engine, path, True)
        root = F.col("Root")
        relative = F.substring(F.col("FullPath"), F.length(root) + 1, F.length("FullPath"))
        kept = [c for c in df.columns if c not in ("Content", "Root")]
        return df.select(relative.alias(f"{name}Relative"), F.struct(*kept).alias(name), F.sha2("Content", 256).alias(f"{name}Hash"))

    both = side(source, "SourceFile").join(side(destination, "DestinationFile"), F.col("SourceFileRelative") == F.col("DestinationFileRelative"), "full")
    state = (
        F.when(F.col("SourceFileRelative").isNull(), "Added")
        .when(F.col("DestinationFileRelative").isNull(), "Removed")
        .when(F.col("SourceFileHash") == F.col("DestinationFileHash"), "TheSame")
        .otherwise("Modified")
    )
    root = lambda path: F.struct(F.lit(path).alias("FullName"))
    return both.select("SourceFile", "DestinationFile", state.alias("State"), root(source).alias("SourceRoot"), root(destination).alias("DestinationRoot"), "SourceFileRelative", "DestinationFileRelative")


#: Names of image tags by number, of the main and of the exposure directory.
EXIF_TAGS = {
    0x010E: "Image Description", 0x010F: "Make", 0x0110: "Model", 0x0112: "Orientation", 0x011A: "X Resolution", 0x011B: "Y Resolution", 0x0128: "Resolution Unit", 0x0131: "Software", 0x0132: "Date/Time", 0x013B: "Artist", 0x8298: "Copyright",
    0x829A: "Exposure Time", 0x829D: "F-Number", 0x8827: "ISO Speed Ratings", 0x9003: "Date/Time Original", 0x9004: "Date/Time Digitized", 0x9209: "Flash", 0x920A: "Focal Length", 0xA002: "Exif Image Width", 0xA003: "Exif Image Height",
}


def exif(data: bytes):
    """Directory, tag and value of an image's exposure data: texts, whole numbers and fractions."""
    order = "little" if data[:2] == b"II" else "big"
    number = lambda at, n: int.from_bytes(data[at : at + n], order)
    size = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8}
    waiting = [("Exif IFD0", number(4, 4))]
    while waiting:
        name, at = waiting.pop(0)
        for k in range(number(at, 2)):
            entry = at + 2 + 12 * k
            tag, kind, count = number(entry, 2), number(entry + 2, 2), number(entry + 4, 4)
            width = size.get(kind, 0) * count
            place = entry + 8 if width <= 4 else number(entry + 8, 4)
            if tag == 0x8769:
                waiting.append(("Exif SubIFD", number(entry + 8, 4)))
            elif tag in EXIF_TAGS and width and place + width <= len(data):
                if kind == 2:
                    value = data[place : place + count].split(b"\0")[0].decode("utf-8", "replace")
                elif kind == 5:
                    value = f"{number(place, 4)}/{number(place + 4, 4)}"
                else:
                    value = number(place, size[kind])
                yield name, EXIF_TAGS[tag], value


def read_tags(path: str, data: bytes):
    """Media tags of a file: image header fields of PNG, GIF, BMP and JPEG; other kinds have none."""
    row = lambda d, t, v: (path, d, t, str(v))
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 26:
        width, height = int.from_bytes(data[16:20], "big"), int.from_bytes(data[20:24], "big")
        yield from (row("PNG-IHDR", "Image Width", width), row("PNG-IHDR", "Image Height", height), row("PNG-IHDR", "Bits Per Sample", data[24]))
    elif data[:6] in (b"GIF87a", b"GIF89a"):
        yield from (row("GIF Header", "Image Width", int.from_bytes(data[6:8], "little")), row("GIF Header", "Image Height", int.from_bytes(data[8:10], "little")))
    elif data[:2] == b"BM" and len(data) >= 26:
        yield from (row("BMP Header", "Image Width", int.from_bytes(data[18:22], "little")), row("BMP Header", "Image Height", int.from_bytes(data[22:26], "little")))
    elif data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(data) and data[at] == 0xFF:
            marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            if marker == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0":
                yield from (row(d, t, v) for d, t, v in exif(data[at + 10 : at + 2 + size]))
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                yield from (row("JPEG", "Image Height", int.from_bytes(data[at + 5 : at + 7], "big")), row("JPEG", "Image Width", int.from_bytes(data[at + 7 : at + 9], "big")))
                return
            at += 2 + size


def tags_of(path: Column, content: Column) -> Column:
    """The tags of a file's content; a file that cannot be read has none. Runs only where a query names them."""

    @F.pandas_udf("array<struct<DirectoryName:string,TagName:string,Description:string>>")
    def run(paths: pd.Series, data: pd.Series) -> pd.Series:
        def one(p, d):
            try:
                return [{"DirectoryName": t[1], "TagName": t[2], "Description": t[3]} for t in read_tags(p, d)]
            except Exception:  # noqa: BLE001  a damaged file has no tags
                return []

        return pd.Series([one(p, d) for p, d in zip(paths, data)], dtype=object)

    return run(path, content)


def metadata(engine, path: str, recursive: bool = False, strict: bool = False) -> DataFrame:
    """A row for each tag of each media file. Files that cannot be read are skipped unless ``strict``."""

    def run(batches):
        for batch in batches:
            rows = []
            for name, data in zip(batch["name"], batch["content"]):
                try:
                    rows += list(read_tags(name, data))
                except Exception:
                    if strict:
                        raise
            yield pd.DataFrame(rows, columns=_columns(TAG), dtype=object)

    return _binary(engine, path, bool(recursive)).select(_bare(F.col("path")).alias("name"), "content").mapInPandas(run, TAG)


def processes(engine) -> DataFrame:
    """Processes of the driver's machine, from its process file system."""
    rows = []
    for pid in filter(str.isdigit, os.listdir("/proc")):
        try:
            with open(f"/proc/{pid}/stat") as f:
                head, _, rest = f.read().partition(") ")
            parts = rest.split()
            rows.append((int(pid), head.partition("(")[2], int(parts[15]), parts[0] not in ("Z", "X"), int(parts[20]), os.readlink(f"/proc/{pid}/exe") if os.access(f"/proc/{pid}/exe", os.R_OK) else None))
        except OSError:
            continue
    return engine.spark.createDataFrame(rows, "Id int, ProcessName string, BasePriority int, Responding boolean, PagedMemorySize64 bigint, FileName string")


def dlls(engine, path: str) -> DataFrame:
    """Library files of a directory; what only their own platform can read of them is left out."""
    df = files(engine, path, True).where(F.lower("Extension").isin(".dll", ".exe"))
    return df.select(F.struct(*[c for c in df.columns if c != "Content"]).alias("FileInfo"), F.lit(None).cast("string").alias("Assembly"), F.lit(None).cast("string").alias("Version"))


def register(registry: Registry) -> None:
    add = lambda schema, name, params, make: registry.add(TableFunction(schema, name, tuple(params), make))
    add("archives", "file", ("path: string",), archive)
    add("os", "files", ("directory: string", "useSubdirectories: bool"), files)
    add("os", "directories", ("directory: string", "useSubdirectories: bool"), directories)
    add("os", "dirscompare", ("sourceDirectory: string", "destinationDirectory: string"), compare)
    add("os", "zip", ("path: string",), zip_listing)
    add("os", "processes", (), processes)
    add("os", "dlls", ("path: string",), dlls)
    add("os", "metadata", ("directoryOrFile: string",), metadata)
    add("os", "metadata", ("directory: string", "throwOnMetadataReadError: bool"), lambda engine, path, strict: metadata(engine, path, False, strict))
    add("os", "metadata", ("directory: string", "useSubdirectories: bool", "throwOnMetadataReadError: bool"), metadata)
    for alias in ("disk",):
        for f in list(registry.methods("os")):
            registry.add(TableFunction(alias, f.name, f.params, f.make, f.lateral))
