"""What training saves: parts of any size, and a manifest, put there last, that names and vouches for them."""

from __future__ import annotations

import json
import uuid

from pyspark.ml import Model, PipelineModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tarmac.contract import FLIGHTS, Contract
from tarmac.session import deleted, exists, listed, publish_text, published_text

MANIFEST = "manifest.json"
FORMAT = 1


class ArtefactError(ValueError):
    """An artefact is incomplete, damaged, or made for other columns."""


def described(contract: Contract) -> dict:
    """The columns, and the order of the vector's slots, that an artefact is made for."""
    return {
        "label": contract.label,
        "features": contract.features,
        "indexes": list(map(list, contract.index_columns.items())),
        "fields": [[f.position, f.name, f.type] for f in contract.fields],
    }


def table_checksum(table: DataFrame) -> dict:
    """Rows, and a hash of them in any order."""
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(table.columns)])
    row = table.agg(F.count("*").alias("rows"), F.bit_xor(hashed).alias("xor"), F.sum(hashed % 1_000_003).alias("sum")).first()
    return {"rows": row["rows"], "xor": row["xor"] or 0, "sum": row["sum"] or 0}


def folder_checksum(spark: SparkSession, path: str) -> dict:
    """Files below a folder, and a hash of their names and contents; read by the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    hashed = F.xxhash64(name, "content")
    row = files.where(name != MANIFEST).agg(F.count("*").alias("n"), F.sum("length").alias("bytes"), F.bit_xor(hashed).alias("xor")).first()
    return {"files": row["n"], "bytes": row["bytes"] or 0, "xor": row["xor"] or 0}


def save(spark: SparkSession, path: str, parts: dict[str, DataFrame | Model], contract: Contract = FLIGHTS) -> None:
    """Save tables and models below ``path``; they count from the moment the manifest is there.

    Each save has a folder of its own, so what was saved before stays whole until the new manifest takes its
    place in one step. The folder before the last is kept for who is reading it; older ones are deleted.
    """
    path = path.rstrip("/")
    before = published_text(spark, f"{path}/{MANIFEST}")
    folder, entries = f"parts-{uuid.uuid4().hex}", {}
    for name, part in parts.items():
        target = f"{path}/{folder}/{name}"
        if isinstance(part, DataFrame):
            part.write.parquet(target)
            entries[name] = {"kind": "table", "schema": part.schema.json(), **table_checksum(spark.read.schema(part.schema).parquet(target))}
        else:
            part.write().save(target)
            entries[name] = {"kind": "model", **folder_checksum(spark, target)}
    manifest = {"format": FORMAT, "folder": folder, "contract": described(contract), "parts": entries}
    publish_text(spark, f"{path}/{MANIFEST}", json.dumps(manifest, indent=1))
    kept = {folder, json.loads(before)["folder"] if before else None}
    for name in listed(spark, path):
        if name.startswith("parts-") and name not in kept:
            deleted(spark, f"{path}/{name}")


def save_pipeline_model(pipeline: PipelineModel, path: str, contract: Contract = FLIGHTS) -> None:
    """A pipeline in its own format, and a manifest beside it."""
    spark, path = SparkSession.active(), path.rstrip("/")
    pipeline.write().overwrite().save(path)
    entry = {"kind": "pipeline", **folder_checksum(spark, path)}
    manifest = {"format": FORMAT, "folder": ".", "contract": described(contract), "parts": {"pipeline": entry}}
    publish_text(spark, f"{path}/{MANIFEST}", json.dumps(manifest, indent=1))


def is_artefact(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path.rstrip('/')}/{MANIFEST}")


def load(spark: SparkSession, path: str, contract: Contract = FLIGHTS, verify: bool = True) -> dict[str, DataFrame | Model]:
    """The parts by name. What is incomplete, damaged or made for other columns is refused.

    ``verify`` reads every part once to compare checksums.
    """
    path = path.rstrip("/")
    text = published_text(spark, f"{path}/{MANIFEST}")
    if text is None:
        raise ArtefactError(f"{path} has no manifest: nothing was saved there, or not to the end")
    manifest = json.loads(text)
    if manifest["format"] != FORMAT:
        raise ArtefactError(f"{path} has the format {manifest['format']}, not {FORMAT}")
    if manifest["contract"] != described(contract):
        raise ArtefactError(f"{path} was made for other columns, or another order of them")
    parts = {}
    for name, entry in manifest["parts"].items():
        target = path if entry["kind"] == "pipeline" else f"{path}/{manifest['folder']}/{name}"
        if not exists(spark, target):
            raise ArtefactError(f"{target} is missing")
        if entry["kind"] == "table":
            part = spark.read.schema(T.StructType.fromJson(json.loads(entry["schema"]))).parquet(target)
        checksum = {k: v for k, v in entry.items() if k not in ("kind", "schema")}
        if verify and checksum != (table_checksum(part) if entry["kind"] == "table" else folder_checksum(spark, target)):
            raise ArtefactError(f"{target} is not what was saved")
        if entry["kind"] == "pipeline":
            part = PipelineModel.load(target)
        elif entry["kind"] == "model":
            part = DefaultParamsReader.loadParamsInstance(target, spark)
        parts[name] = part
    return parts
