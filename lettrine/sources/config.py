"""Configuration: one YAML file read into a dataclass, with secrets from the environment."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field, fields

_SECRET = re.compile(r"=?\$\{([^}]*)\}")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


class ConfigError(ValueError):
    """The configuration can't be used."""


def resolve_secret(value: str, env: dict[str, str] | None = None) -> str:
    """``${NAME}`` or ``=${NAME}`` as a whole stands for a variable, read once; anything else is itself."""
    m = _SECRET.fullmatch(value)
    if not m:
        return value
    if not _NAME.fullmatch(m[1]):
        raise ConfigError(f"invalid variable reference `{value}`")
    found = (os.environ if env is None else env).get(m[1], "")
    if not found:
        raise ConfigError(f"variable `{m[1]}` is not set or empty")
    return found


@dataclass
class Account:
    name: str = ""
    host: str = ""
    port: int = 993
    login: str = ""
    password: str = ""
    sslEnabled: bool = True
    recover: bool = False
    groupByContact: bool = True
    foldersIn: list[str] = field(default_factory=list)
    foldersOut: list[str] = field(default_factory=list)


@dataclass
class Config:
    """Keys as in the YAML file; the defaults are fixed values."""

    baseFolder: str = "."
    parseIaFolder: str = "parse-ai"
    aiEnabled: bool = False
    aiModel: str = ""
    aiApiKey: str = ""
    aiBaseUrl: str = ""
    aiOutputSuffix: str = ".ai.json"
    aiAgentsFile: str = "AGENTS.md"
    aiMaxAttachmentBytes: int = 2_000_000
    aiMaxAttachmentsPerEmail: int = 12
    aiRetryCount: int = 2
    aiTimeoutSeconds: int = 120
    aiRequestDelayMs: int = 0
    aiSendRawImages: bool = False
    dropboxRootFolder: str = ""
    dropboxTimeoutSeconds: int = 120
    accounts: list[Account] = field(default_factory=list)
    path: str = "config.yml"


def _scalar(text: str) -> object:
    text = text.strip()
    if text[:1] in "\"'" and text[-1:] == text[:1] and len(text) > 1:
        return text[1:-1]
    if text.lower() in ("true", "false"):
        return text.lower() == "true"
    if text.startswith("[") and text.endswith("]"):
        return [_scalar(x) for x in text[1:-1].split(",") if x.strip()]
    return int(text) if re.fullmatch(r"-?\d+", text) else text


def parse_yaml(text: str) -> dict:
    """Nested maps and lists of scalars and maps, by indentation: what the configuration uses. PyYAML is used where it is there."""
    try:
        import yaml

        return yaml.safe_load(text) or {}
    except ImportError:
        pass
    lines = [(len(x) - len(x.lstrip()), x.strip()) for x in (re.sub(r"(^|\s)#.*$", "", y) for y in text.splitlines()) if x.strip()]

    def block(i: int, indent: int) -> tuple[object, int]:
        if lines[i][1].startswith("- "):
            out: list = []
            while i < len(lines) and lines[i][0] == indent and lines[i][1].startswith("- "):
                rest = lines[i][1][2:]
                if re.match(r"[\w.-]+:(\s|$)", rest):
                    lines[i] = (indent + 2, rest)
                    item, i = block(i, indent + 2)
                else:
                    item, i = _scalar(rest), i + 1
                out.append(item)
            return out, i
        found: dict = {}
        while i < len(lines) and lines[i][0] == indent and not lines[i][1].startswith("- "):
            key, _, rest = lines[i][1].partition(":")
            i += 1
            if rest.strip():
                found[key.strip()] = _scalar(rest)
            elif i < len(lines) and (lines[i][0] > indent or lines[i][0] == indent and lines[i][1].startswith("- ")):
                found[key.strip()], i = block(i, lines[i][0])
            else:
                found[key.strip()] = None
        return found, i

    return block(0, lines[0][0])[0] if lines else {}


def load(path: str | None, env: dict[str, str] | None = None) -> Config:
    path = (path or "").strip() or "./config.yml"
    with open(path, encoding="utf-8") as f:
        raw = parse_yaml(f.read())
    secret = lambda v: resolve_secret(v, env) if isinstance(v, str) else v
    known = {f.name for f in fields(Config)} - {"accounts", "path"}
    config = Config(**{k: secret(v) for k, v in raw.items() if k in known and v is not None}, path=path)
    names = {f.name for f in fields(Account)}
    config.accounts = [Account(**{k: secret(v) for k, v in a.items() if k in names and v is not None}) for a in raw.get("accounts") or []]
    return config


def agents_path(config: Config, given: str | None = None) -> str:
    """Command line before configuration before the default; relative to the configuration's folder."""
    chosen = given or config.aiAgentsFile or "AGENTS.md"
    return chosen if os.path.isabs(chosen) else os.path.join(os.path.dirname(os.path.abspath(config.path)), chosen)


def root_folder(config: Config, given: str | None = None) -> str:
    chosen = (given or "").strip() or config.dropboxRootFolder.strip()
    if not chosen:
        raise ConfigError("no root folder: give --root or set it in the configuration")
    return chosen


def access_token(options: dict[str, str], refresh=None) -> str:
    """A direct token, else one from the refresh flow through ``refresh(token, key, secret)``."""
    if options.get("token"):
        return options["token"]
    if not options.get("refresh_token"):
        raise ConfigError("no access token and no refresh token")
    if not options.get("app_key") or not options.get("app_secret"):
        raise ConfigError("a refresh token needs the application's key and secret")
    if refresh is None:
        raise ConfigError("no connector for the refresh flow")
    return refresh(options["refresh_token"], options["app_key"], options["app_secret"])
