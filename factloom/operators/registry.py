"""A content-addressed model registry on a file system the driver sees."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import subprocess
from datetime import datetime, timezone


class Registry:
    def __init__(self, root: str):
        self.root = root

    def versions(self) -> list[str]:
        return sorted(d for d in os.listdir(self.root) if d.startswith("v")) if os.path.isdir(self.root) else []

    def folder(self, version: str) -> str:
        return os.path.join(self.root, version)

    def latest(self) -> str | None:
        return (self.versions() or [None])[-1]

    def register(self, artifact: str, metadata: dict | None = None, now: datetime | None = None) -> str:
        """Store an artifact's text; the version is its time and digest.  The folder appears at once and whole."""
        now = now or datetime.now(timezone.utc)
        digest = hashlib.sha256(artifact.encode()).hexdigest()
        name = f"v{now:%Y%m%dT%H%M%S}{now.microsecond // 1000:03d}Z-{digest[:8]}"
        version, n = name, 0
        while os.path.exists(os.path.join(self.root, version)):
            n += 1
            version = f"{name}.{n}"
        staging = os.path.join(self.root, f".staging-{version}")
        os.makedirs(staging)
        with open(os.path.join(staging, "model.json"), "w") as f:
            f.write(artifact)
        meta = {"version": version, "sha256": digest, "created_at": now.isoformat()} | (metadata or {})
        with open(os.path.join(staging, "metadata.json"), "w") as f:
            json.dump(meta, f, sort_keys=True)
        with open(os.path.join(staging, "MODEL_CARD.md"), "w") as f:
            f.write(card(meta))
        os.rename(staging, os.path.join(self.root, version))
        return version

    def metadata(self, version: str) -> dict:
        with open(os.path.join(self.root, version, "metadata.json")) as f:
            return json.load(f)

    def load(self, version: str) -> str:
        """The artifact's text; ValueError if it isn't what was registered."""
        with open(os.path.join(self.root, version, "model.json")) as f:
            text = f.read()
        if hashlib.sha256(text.encode()).hexdigest() != self.metadata(version)["sha256"]:
            raise ValueError(f"{version} has been changed")
        return text

    def verify(self, version: str) -> bool:
        try:
            return bool(self.load(version)) or True
        except (OSError, ValueError):
            return False

    def promote(self, version: str) -> None:
        """Point production at a version that still verifies."""
        self.load(version)
        with open(os.path.join(self.root, "production.tmp"), "w") as f:
            f.write(version)
        os.replace(os.path.join(self.root, "production.tmp"), os.path.join(self.root, "production"))

    def production(self) -> str | None:
        there = os.path.join(self.root, "production")
        if not os.path.exists(there):
            return None
        with open(there) as f:
            return f.read()

    def remove(self, version: str) -> None:
        shutil.rmtree(os.path.join(self.root, version))


def file_sha256(path: str, block: int = 1 << 20) -> str:
    """SHA-256 of a file, read block by block."""
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while part := f.read(block):
            h.update(part)
    return h.hexdigest()


def provenance(libraries: tuple[str, ...] = ("pyspark", "numpy", "pandas", "pyarrow"), cwd: str | None = None) -> dict:
    """The commit that is checked out, "unknown" where there is none, and the versions of libraries."""
    from importlib.metadata import PackageNotFoundError, version

    def of(name: str) -> str:
        try:
            return version(name)
        except PackageNotFoundError:
            return "absent"

    try:
        sha = subprocess.run(["git", "rev-parse", "HEAD"], cwd=cwd, capture_output=True, text=True, timeout=10, check=True).stdout.strip()
    except (OSError, subprocess.SubprocessError):
        sha = "unknown"
    return {"git_sha": sha, "libraries": {n: of(n) for n in libraries}}


def gate_summary(candidate: dict[str, float], before: dict[str, float] | None, why: list[str]) -> str:
    """The gate's verdict in Markdown, each figure beside the one of the model in production."""
    rows = "".join(f"| {k} | {v:.3f} | {'-' if before is None or k not in before else format(before[k], '.3f')} |\n" for k, v in sorted(candidate.items()))
    said = "".join(f"- {w}\n" for w in why) or "- none\n"
    return f"# Gate: {'failed' if why else 'passed'}\n\n| figure | candidate | production |\n|-|-|-|\n{rows}\nReasons:\n{said}"


def figures(text: str, names: tuple[str, ...] = ("recall", "precision", "f1", "flag_rate", "roc_auc")) -> dict[str, float]:
    """The gated figures of a metrics document; KeyError names one that isn't there."""
    found = json.loads(text)
    return {n: float(found[n]) for n in names}


def card(meta: dict) -> str:
    """A model card in Markdown."""
    rows = "".join(f"| {k} | {v} |\n" for k, v in sorted(meta.items()) if not isinstance(v, dict))
    figures = "".join(f"- {k}: {v:.4g}\n" for k, v in sorted(meta.get("metrics", {}).items()))
    return f"# Model {meta['version']}\n\n| field | value |\n|-|-|\n{rows}\n{figures}"


def matrix_digest(rows: list[tuple], names: list[str]) -> str:
    """SHA-256 over labels, names and values rounded to six places."""
    h = hashlib.sha256(json.dumps(names).encode())
    for label, *values in sorted(rows):
        h.update(json.dumps([label, *(round(float(v), 6) for v in values)]).encode())
    return h.hexdigest()
