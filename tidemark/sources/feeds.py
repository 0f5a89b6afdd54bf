"""The two feeds: parameters, headers, and fetching through an injected GET. Nothing is landed that breaks its contract."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from pathlib import Path

try:
    import yaml
except ImportError:  # plain mappings are read without it
    yaml = None

from tidemark.sources.bronze import land_capture
from tidemark.sources.contracts import CONTRACTS, validate

#: get(url, params, headers, timeout) -> (status, payload)
Get = Callable[[str, dict, dict, int], tuple[int, dict]]
DATASETS = ("weather", "energy")


@dataclass(frozen=True)
class Feed:
    """A feed's address and parameters; a header and the variable that holds its value go together or not at all."""

    dataset: str
    url: str
    params: dict = field(default_factory=dict)
    timeout: int = 30
    key_header: str | None = None
    key_env: str | None = None
    key_param: str | None = None

    def secret(self, env: Mapping[str, str] | None = None) -> str | None:
        if not self.key_env:
            return None
        value = (os.environ if env is None else env).get(self.key_env, "")
        if not value:
            raise ValueError(f"environment variable {self.key_env} is not set")
        return value

    def headers(self, env: Mapping[str, str] | None = None) -> dict[str, str]:
        if self.key_param:
            return {}
        if bool(self.key_header) != bool(self.key_env):
            raise ValueError("key_header and key_env must be set together")
        return {self.key_header: self.secret(env)} if self.key_header else {}


def _plain_mapping(text: str) -> dict:
    """The mapping `api` of a YAML text with plain values and one inner mapping, `params`, for where no YAML library is."""
    api, params, inside = {}, {}, None
    for line in text.splitlines():
        body = line.split(" #")[0].rstrip()
        if not body.strip() or body.lstrip().startswith("#"):
            continue
        depth, (name, _, value) = len(body) - len(body.lstrip()), body.strip().partition(":")
        value = value.strip().strip("\"'")
        if depth == 0 or not value:
            inside = name
            continue
        (params if inside == "params" and depth > 2 else api)[name] = int(value) if value.isdigit() else value
    return api | {"params": params}


def read_config(text: str) -> dict:
    """The mapping `api` of a YAML text: with the YAML library, whatever it holds, lists and quoted texts too."""
    if yaml is None:
        return _plain_mapping(text)
    try:
        found = yaml.safe_load(text)
    except yaml.YAMLError as e:
        raise ValueError(f"the configuration isn't YAML: {e}") from e
    api = found.get("api") if isinstance(found, dict) else None
    if not isinstance(api, dict) or not isinstance(api.get("params") or {}, dict):
        raise ValueError("the configuration needs a mapping `api`, whose `params` are a mapping if they are given")
    return api


def load_feed(path: str, dataset: str) -> Feed:
    """A feed from a YAML file with a mapping `api`; a missing file is an error that says how to make one."""
    if not Path(path).is_file():
        raise FileNotFoundError(f"{path} is missing: copy the template beside it (config.example.yaml) and fill it in")
    api = read_config(Path(path).read_text())
    url = "/".join(str(api[k]).strip("/") for k in ("base_url", "endpoint") if k in api)
    return Feed(dataset, url, api.get("params") or {}, api.get("timeout_seconds", 30), api.get("api_key_header"), api.get("api_key_env"), api.get("api_key_param"))


def checked(feed: Feed, get: Get, env: Mapping[str, str] | None, contract: dict) -> dict:
    """The payload of one GET, after the status and the contract have been checked."""
    params = dict(feed.params) | ({feed.key_param: feed.secret(env)} if feed.key_param else {})
    status, payload = get(feed.url, params, feed.headers(env), feed.timeout)
    if not 200 <= status < 300:
        raise OSError(f"{feed.dataset}: HTTP status {status}")
    validate(payload, contract, f"{feed.dataset}_schema.json")
    return payload


def fetch(feed: Feed, get: Get, env: Mapping[str, str] | None = None) -> dict:
    """The feed's payload, after the status and the contract have been checked."""
    return checked(feed, get, env, CONTRACTS[feed.dataset])


def ingest(feeds: dict[str, Feed], get: Get, root: str, dataset: str = "all", env: Mapping[str, str] | None = None, now: datetime | None = None) -> list[str]:
    """Fetch and land the chosen dataset, or all; the paths written."""
    chosen = dataset.lower()
    if chosen not in ("all", *DATASETS):
        raise ValueError(f"dataset must be one of: all, {', '.join(DATASETS)}")
    return [land_capture(root, d, fetch(feeds[d], get, env), now) for d in DATASETS if chosen in ("all", d)]


def resource_ids(package: dict) -> dict[str, str]:
    """Resource names and ids in the answer of a package lookup."""
    return {r.get("name") or r["id"]: r["id"] for r in package.get("result", {}).get("resources", [])}
