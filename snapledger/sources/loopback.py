"""A transport that answers from arithmetic: for trials of paged extracts without a network.

``loop://offset/TOTAL/SIZE`` serves the numbers below TOTAL by pages, ``loop://next/TOTAL/SIZE`` by next
links, ``loop://key/K`` one record for each whole number K; keys divisible by 7 are not found, and
those divisible by 11 are refused once for each time ``retry`` names in the URL's query.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any
from urllib.parse import parse_qs, urlsplit


def serve(url: str, params: Mapping[str, Any]) -> tuple[int, str, float | None]:
    parts = urlsplit(url)
    path, asked = parts.path.strip("/").split("/"), {k: v[0] for k, v in parse_qs(parts.query).items()} | {k: str(v) for k, v in params.items()}
    if parts.netloc == "key":
        key = int(path[0])
        if key % 7 == 0:
            return 404, "", None
        if key % 11 == 0 and asked.get("deny"):
            return 403, "Access denied by the web filter", None
        return 200, json.dumps({"key": key, "square": key * key}), None
    total, size = int(path[0]), int(path[1])
    at = int(asked.get("at", 0)) if parts.netloc == "next" else int(asked.get("page", 0)) * size
    rows = [{"id": i} for i in range(at, min(total, at + size))]
    if parts.netloc == "next":
        more = at + size < total
        return 200, json.dumps({"value": rows, "nextLink": f"loop://next/{total}/{size}?at={at + size}" if more else None}), None
    return 200, json.dumps({"content": rows, "totalElements": total, "totalPages": -(-total // size)}), None
