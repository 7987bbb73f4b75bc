"""Engine settings: defaults, then environment, then a JSON file; unknown keys are reported and dropped."""

from __future__ import annotations

import json
import os
import warnings
from dataclasses import dataclass, fields, replace
from pathlib import Path

PREFIX = "RECOLLECT_"
_ON = ("1", "true", "yes", "on")
_OFF = ("0", "false", "no", "off", "")
DISPLAY_LEVELS = ("off", "summary", "verbose")


_WARNED: set[str] = set()


def warn_once(key: str, message: str) -> bool:
    """Warn about ``key`` the first time only; whether this was it."""
    if key in _WARNED:
        return False
    _WARNED.add(key)
    warnings.warn(message, stacklevel=3)
    return True


def display_level(value, default: str = "off") -> str:
    """off, summary or verbose; anything else is the default, with one warning for each such value."""
    text = str(value if value is not None else default).strip().lower()
    if text not in DISPLAY_LEVELS:
        warn_once(f"display_level:{text}", f"display_level: {value!r} is none of {', '.join(DISPLAY_LEVELS)}")
        return default
    return text


@dataclass(frozen=True)
class EngineConf:
    dims: int = 64
    metric: str = "cosine"
    top_k: int = 10
    hybrid: bool = False
    gate: bool = True
    temporal: bool = False
    entities: bool = False
    rerank: bool = False
    display_level: str = "off"

    def changed(self, source: str, values: dict) -> EngineConf:
        """A copy with the values that fit; what does not is warned about and left as it was."""
        kinds, out = {f.name: type(f.default) for f in fields(self)}, {}
        for key, value in values.items():
            if key not in kinds:
                warnings.warn(f"{source}: unknown setting {key!r}", stacklevel=2)
                continue
            try:
                out[key] = _parsed(key, value, kinds[key])
            except ValueError as e:
                warnings.warn(f"{source}: {e}", stacklevel=2)
        return replace(self, **out)


def _parsed(key: str, value, kind: type):
    if kind is bool:
        text = str(value).strip().lower()
        if text not in _ON + _OFF:
            raise ValueError(f"{key}: {value!r} is neither on nor off")
        return text in _ON
    if key == "display_level" and str(value).strip().lower() not in DISPLAY_LEVELS:
        raise ValueError(f"{key}: one of {', '.join(DISPLAY_LEVELS)} is needed")
    return kind(str(value).strip().lower() if kind is str else value)


def load(path: str | None = None, env: dict[str, str] | None = None) -> EngineConf:
    """Settings with the environment and the file applied; a file that cannot be read changes nothing."""
    env = dict(os.environ) if env is None else env
    names = {f.name for f in fields(EngineConf)}
    conf = EngineConf().changed("environment", {k[len(PREFIX) :].lower(): v for k, v in env.items() if k.startswith(PREFIX) and k[len(PREFIX) :].lower() in names})
    if path and Path(path).exists():
        try:
            values = json.loads(Path(path).read_text())
            conf = conf.changed(path, values if isinstance(values, dict) else {})
        except ValueError as e:
            warnings.warn(f"{path}: {e}", stacklevel=2)
    return conf


def save(path: str, values: dict, secret: tuple[str, ...] = ("api_key",)) -> None:
    """Merge values into the file, without secrets, in one step and readable by its owner only."""
    target = Path(path)
    old = json.loads(target.read_text()) if target.exists() else {}
    new = {k: v for k, v in (old | values).items() if k not in secret}
    part = target.with_suffix(".part")
    part.write_text(json.dumps(new, indent=1, sort_keys=True))
    part.chmod(0o600)
    part.replace(target)
