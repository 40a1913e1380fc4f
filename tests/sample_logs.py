"""Small log files made with sqlite3 and zipfile."""

from __future__ import annotations

import io
import sqlite3
import struct
import zipfile
from pathlib import Path

START = "2018-03-10 07:00:00.000"
END = "2018-03-10 08:00:00.000"
START_EPOCH = 1520665200


def point(lon: float, lat: float) -> bytes:
    xy = struct.pack("<dd", lon, lat)
    return bytes.fromhex("0001E6100000") + xy + xy + b"\x7c" + struct.pack("<I", 1) + xy + b"\xfe"


EXAMPLE_POINT = bytes.fromhex(
    "0001E6100000DD30C0F46C2A594041432013008E2B40DD30C0F46C2A594041432013008E2B40"
    "7C01000000DD30C0F46C2A594041432013008E2B40FE"
)


def log_hash(imei_tail: int, epoch: int = START_EPOCH) -> int:
    return (imei_tail << 32) | epoch


def logs_table(hash_value, start=START, end=END, offset=0, version="v3.0.800", imei="358096071732800"):
    return (
        '"log_hash" BIGINT,"log_start_time" DATETIME,"log_end_time" DATETIME,"log_timezone_offset" INT,'
        '"log_app_version" TEXT,"imei" TEXT',
        [(hash_value, start, end, offset, version, imei)],
    )


def database(tables: dict[str, tuple[str, list[tuple]]]) -> bytes:
    db = sqlite3.connect(":memory:")
    for name, (columns, rows) in tables.items():
        db.execute(f'create table "{name}" ({columns})')
        if rows:
            marks = ",".join("?" * len(rows[0]))
            db.executemany(f'insert into "{name}" values ({marks})', rows)
    db.commit()
    return db.serialize()


def archive(image: bytes, member: str = "azqdata.db") -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(member, image)
    return out.getvalue()


def write_log(folder: Path, name: str, tables: dict) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_bytes(archive(database(tables)))
    return str(path)


SIGNALLING = '"time" DATETIME,"time_ms" INT,"posid" INT,"seqid" INT,"netid" INT,"log_hash" BIGINT,"geom" BLOB,"symbol" TEXT,"info" TEXT'


def plain_log(hash_value: int, **logs) -> dict:
    """A log with the usual tables and all the awkward values."""
    h = hash_value
    return {
        "logs": logs_table(h, **logs),
        "signalling": (
            SIGNALLING,
            [
                ("2018-03-10 07:01:00.123", 1, 1, 1, 1, h, EXAMPLE_POINT, "send", "line one,\n\"two\"\nNaTional"),
                ("2018-03-10 07:02:00.000", 1, 1, 2, 1, h, b"", "recv", ""),
                ("2018-03-10 07:03:00.000", 1, 2, 3, 1, h, None, None, "NaT"),
                ("2018-03-08 07:00:00.000", 1, 2, 4, 1, h, b"\x00\x01junk", "send", "first kept"),
                ("2018-03-08 06:59:59.999", 1, 2, 5, 1, h, None, "send", "too early"),
                ("2018-03-12 08:00:00.000", 1, 2, 6, 1, h, None, "send", "last kept"),
                ("2018-03-12 08:00:00.001", 1, 2, 7, 1, h, None, "send", "too late"),
                (None, 1, 2, 8, 1, h, None, "send", "no time"),
            ],
        ),
        "location": (
            '"time" DATETIME,"posid" INT,"log_hash" BIGINT,"geom" BLOB',
            [("2018-03-10 07:01:00.000", 1, h, point(100.5, 13.75)), ("2018-03-10 07:02:00.000", 2, h, point(-0.1276, 51.5072))],
        ),
        "log_info": (
            '"time" DATETIME,"seqid" INT,"log_hash" BIGINT,"IMEI" TEXT',
            [("2018-03-10 07:00:01.000", 1, h, "111"), ("2018-03-10 07:00:02.000", 2, h, "222"), ("2018-03-10 07:00:03.000", 3, h, "")],
        ),
        "android_info_1sec": ('"time" DATETIME,"log_hash" BIGINT', [("2018-03-10 07:30:00.000", h), (END, h)]),
        "kpi": (
            '"time" DATETIME,"posid" INT,"log_hash" BIGINT,"lte_rsrp" Double,"lte_earfcn" smallint,"modem_time" DATETIME,'
            '"gsm_bsic" TEXT,"gsm_band" TEXT,"android_cellid_from_cellfile" INT,"x_duration" TEXT,"x_trip_time" real,'
            '"exynos_basic_info_nr_cellid" BIGINT,"note" DATETIME',
            [
                ("2018-03-10 07:01:00.000", 1, h, -80.5, 1800, "159841018-03-10 07:24:42.191", "1234567", "GSM900", "12abc", "", "4.5", "18446744073709551615", "a"),
                ("2018-03-10 07:02:00.000", 2, h, None, None, "2018-03-10 07:02:00.123456", "12", "GSM1800", "abc", "1.5", None, 5, None),
                ("2018-03-10 07:03:00.000", 9, h, -90.25, 3, None, None, None, None, None, None, None, ""),
            ],
        ),
        "nr_cell_meas": (
            '"time" DATETIME,"log_hash" BIGINT,"pci" int,"rsrp" Double',
            [("2018-03-10 07:01:00.000", h, "12x", "-1.5dB"), ("2018-03-10 07:01:01.000", h, None, None)],
        ),
        "wifi_scanned": ('"time" DATETIME,"log_hash" BIGINT', [("2018-03-10 07:01:00.000", h)]),
        "spatial_ref_sys": ('"srid" INT', [(1,)]),
        "android_metadata": ('"locale" TEXT', [("en",)]),
        "x_layer_statistics": ('"time" DATETIME', [(START,)]),
        "spatialite_history": ('"time" DATETIME', [(START,)]),
        "no_time": ('"a" INT', [(1,)]),
    }
