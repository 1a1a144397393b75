"""Lookups over HTTP: health, a customer's recommendations, and request metrics.

``GET /health``, ``GET /recommend/{customer_id}?k=`` and ``GET /metrics``, from
the standard library's server. A lookup filters the store by customer, so on a
table written by ``store.save`` it reads one bucket. Metrics are in Prometheus'
text format; every series is there from the start, at 0.
"""

from __future__ import annotations

import json
import threading
import time
from bisect import bisect_left
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, unquote, urlsplit

from pyspark.sql import DataFrame

from tidewell.operators.store import recommend

ENDPOINTS = {"health": (200,), "recommend": (200, 404, 422, 500), "metrics": (200,), "other": (404,)}
#: Upper ends of the histogram's buckets, in seconds.
EDGES = (0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
PLAIN, JSON = "text/plain; version=0.0.4; charset=utf-8", "application/json"


class Metrics:
    """Requests by endpoint and status, and a histogram of their seconds by endpoint."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._requests = {(e, s): 0 for e, statuses in ENDPOINTS.items() for s in statuses}
        self._buckets = {e: [0] * (len(EDGES) + 1) for e in ENDPOINTS}
        self._seconds = dict.fromkeys(ENDPOINTS, 0.0)

    def add(self, endpoint: str, status: int, seconds: float) -> None:
        with self._lock:
            self._requests[endpoint, status] += 1
            self._buckets[endpoint][bisect_left(EDGES, seconds)] += 1
            self._seconds[endpoint] += seconds

    def text(self) -> str:
        with self._lock:
            out = ["# TYPE tidewell_requests_total counter"]
            out += [f'tidewell_requests_total{{endpoint="{e}",status="{s}"}} {n}' for (e, s), n in self._requests.items()]
            out.append("# TYPE tidewell_request_seconds histogram")
            for e, counts in self._buckets.items():
                so_far = 0
                for edge, n in zip((*map(str, EDGES), "+Inf"), counts, strict=True):
                    so_far += n
                    out.append(f'tidewell_request_seconds_bucket{{endpoint="{e}",le="{edge}"}} {so_far}')
                out += [f'tidewell_request_seconds_sum{{endpoint="{e}"}} {self._seconds[e]:.6f}', f'tidewell_request_seconds_count{{endpoint="{e}"}} {so_far}']
        return "\n".join(out) + "\n"


class Service:
    """Answers for paths, apart from any socket."""

    def __init__(self, store: DataFrame, run: dict | None = None):
        self.store, self.run, self.metrics = store, run or {}, Metrics()

    def answer(self, target: str) -> tuple[int, str, str]:
        """Status, content type and body; a failing lookup is a 500, and is counted like any other answer."""
        began = time.perf_counter()
        url = urlsplit(target)
        parts = url.path.strip("/").split("/")
        if parts == ["metrics"]:
            endpoint, status, kind, body = "metrics", 200, PLAIN, self.metrics.text()
        elif parts == ["health"]:
            endpoint, status, kind, body = "health", 200, JSON, json.dumps({"status": "ok", **self.run}, default=str)
        elif len(parts) == 2 and parts[0] == "recommend":
            endpoint, kind = "recommend", JSON
            try:
                status, found = self._recommend(unquote(parts[1]), parse_qs(url.query, keep_blank_values=True).get("k", ["12"])[-1])
            except Exception as e:
                status, found = 500, {"error": type(e).__name__}
            body = json.dumps(found, default=str)
        else:
            endpoint, status, kind, body = "other", 404, JSON, json.dumps({"error": "unknown path"})
        self.metrics.add(endpoint, status, time.perf_counter() - began)
        return status, kind, body

    def _recommend(self, customer: str, k: str) -> tuple[int, dict]:
        if not (k.isascii() and k.isdigit() and len(k) <= 2 and 1 <= int(k) <= 12):
            return 422, {"error": "k must be from 1 to 12"}
        found = recommend(self.store, customer, int(k))
        return (404, {"error": "unknown customer"}) if found is None else (200, {**found, **self.run})


def server(service: Service, host: str = "127.0.0.1", port: int = 8000) -> ThreadingHTTPServer:
    """A server that answers each request in a thread of its own; ``serve_forever`` starts it, port 0 takes a free one."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:  # the base class fixes the name
            status, kind, body = service.answer(self.path)
            raw = body.encode()
            self.send_response(status)
            self.send_header("Content-Type", kind)
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def log_message(self, *_: object) -> None:
            """Requests are counted, not logged."""

    return ThreadingHTTPServer((host, port), Handler)
