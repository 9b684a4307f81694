"""Binary artefacts: archives, audio headers, and decoders that have no built-in form (Arrow batches)."""

from __future__ import annotations

import io
import wave
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators.batches import BATCH_BYTES, bound_batches

WAV = T.StructType([*[T.StructField(c, T.IntegerType()) for c in ("channels", "sample_rate_hz", "bit_depth")], T.StructField("duration_seconds", T.DoubleType()), T.StructField("total_frames", T.LongType())])
UNSAFE_PATH = r"(^/)|(^|/)\.\.(/|$)|\\"


def safe_path(name: Column) -> Column:
    """No absolute path, no parent folder, no backslash."""
    return ~name.rlike(UNSAFE_PATH)


MEMBER_SQL = "path string, member string, depth int, size long, compressed long, crc32 string, encrypted boolean, compression string, data binary"


def zip_members(files: DataFrame, path: str = "path", content: str = "content", depth: int = 2, most_bytes: int = 64 << 20) -> DataFrame:
    """Members of archives, nested ones too up to ``depth``, with their bytes if readable and of at most most_bytes.

    A file that is no archive gives no row; directories are left out. Batches in and out are bounded in bytes
    (a larger member is one alone), so a task holds an archive, its members that are open and a batch of rows.
    """
    bound_batches(files.sparkSession)

    def walk(name: str, data: bytes, level: int) -> Iterator[tuple]:
        try:
            archive = zipfile.ZipFile(io.BytesIO(data))
        except zipfile.BadZipFile:
            return
        for info in archive.infolist():
            if info.is_dir():
                continue
            locked, inner = bool(info.flag_bits & 1), None
            if not locked and info.file_size <= most_bytes:
                try:
                    inner = archive.read(info)
                except (zipfile.BadZipFile, NotImplementedError, OSError, EOFError):
                    inner = None
            kind = {zipfile.ZIP_DEFLATED: "Deflated", zipfile.ZIP_STORED: "Stored"}.get(info.compress_type, f"Type_{info.compress_type}")
            yield name, info.filename, level, info.file_size, info.compress_size, f"0x{info.CRC:08X}", locked, kind, inner
            if inner is not None and level < depth and inner[:2] == b"PK":
                yield from walk(f"{name}/{info.filename}", inner, level + 1)

    def expand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in MEMBER_SQL.split(", ")]
        held, size = [], 0
        for frame in frames:
            for name, data in zip(frame["p"], frame["c"], strict=True):
                for member in walk(name, data, 1):
                    held.append(member)
                    size += len(member[-1] or b"") + 256
                    if size >= BATCH_BYTES:
                        yield pd.DataFrame(held, columns=names)
                        held, size = [], 0
        if held:
            yield pd.DataFrame(held, columns=names)

    return files.select(F.col(path).alias("p"), F.col(content).alias("c")).mapInPandas(expand, MEMBER_SQL)


@F.pandas_udf(WAV)
def wav_header(content: pd.Series) -> pd.DataFrame:
    """Fields of a WAV file; nulls where it is none."""
    out = []
    for data in content:
        try:
            with wave.open(io.BytesIO(data), "rb") as w:
                rate, frames = w.getframerate(), w.getnframes()
                out.append((w.getnchannels(), rate, w.getsampwidth() * 8, round(frames / rate, 2) if rate else 0.0, frames))
        except (wave.Error, EOFError, TypeError):
            out.append((None, None, None, None, None))
    return pd.DataFrame(out, columns=["channels", "sample_rate_hz", "bit_depth", "duration_seconds", "total_frames"])


@F.pandas_udf(T.StringType())
def pdf_text(content: pd.Series) -> pd.Series:
    """Text of PDF files, a page a line; a bracketed note where there is none or it can't be read. Null gives null."""

    def read(data: bytes) -> str:
        try:
            import pypdf

            pages = [page.extract_text() for page in pypdf.PdfReader(io.BytesIO(data)).pages]
        except Exception as error:  # noqa: BLE001  whatever the parser meets is told in the text
            return f"[PDF parsing error: {error}]"
        text = "".join(p + "\n" for p in pages if p)
        return text if text.strip() else "[Empty PDF content]"

    return content.map(read, na_action="ignore")


def file_text(name: Column, content: Column) -> Column:
    """A file's text: PDF pages, or bytes as UTF-8 with U+FFFD for what is not."""
    is_pdf = F.lower(name).endswith(".pdf")
    return F.when(is_pdf, pdf_text(F.when(is_pdf, content))).otherwise(F.make_valid_utf8(content.cast("string")))


@F.pandas_udf(T.StringType())
def xor_text(text: pd.Series, key: pd.Series) -> pd.Series:
    """Text under a repeating key; an empty key changes nothing."""

    def turn(value: str | None, by: str | None) -> str | None:
        if value is None or not by:
            return value
        data, k = value.encode(), by.encode()
        return bytes(b ^ k[i % len(k)] for i, b in enumerate(data)).decode("utf-8", "ignore")

    return pd.Series([turn(v, k) for v, k in zip(text, key, strict=True)])
