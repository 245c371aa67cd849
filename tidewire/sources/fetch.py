"""Fetching feeds: every hop is checked before it is made, bodies are bounded, a source that fails is a row.

The client is injectable, so a run can be tested without a network; the executors' own one uses the standard library,
connects to the address that was checked, and follows no redirect by itself.
"""

from __future__ import annotations

import http.client
import ipaddress
import socket
import ssl
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame

# Hops after the first, bytes of a body, seconds to connect and to read, tries and the wait between them.
REDIRECTS, BODY_BYTES, CONNECT_SECONDS, READ_SECONDS, RETRIES, RETRY_WAIT = 3, 5 << 20, 5.0, 15.0, 1, 2.0
FETCHED = "source_id string, url string, status int, content binary, error string, duration_seconds double"


class Refused(Exception):
    """The url leads somewhere a fetcher must not go; trying again changes nothing."""


class FetchError(Exception):
    """The fetch failed."""


@dataclass(frozen=True)
class Hop:
    """One answer: its status, where it leads, and its body in pieces."""

    status: int
    location: str | None
    body: Iterable[bytes]


#: (url, address) -> one answer, without following redirects.
Client = Callable[[str, str], Hop]
Resolver = Callable[[str], list[str]]


def resolve(host: str) -> list[str]:
    try:
        return sorted({info[4][0] for info in socket.getaddrinfo(host, None, type=socket.SOCK_STREAM)})
    except OSError as e:
        raise FetchError(f"{host} doesn't resolve") from e


def _public(address: str) -> bool:
    ip = ipaddress.ip_address(address.split("%", 1)[0])
    inner = getattr(ip, "ipv4_mapped", None) or getattr(ip, "sixtofour", None)
    return ip.is_global and not ip.is_multicast and (inner is None or inner.is_global)


def checked_address(url: str, resolver: Resolver = resolve) -> str:
    """The address to connect to; Refused unless the url is plain http(s) and all of its host's addresses are public."""
    try:
        parts = urlsplit(url)
        port = parts.port
    except ValueError as e:
        raise Refused(f"not a url: {url[:200]}") from e
    if parts.scheme not in ("http", "https") or not parts.hostname or parts.username is not None or parts.password is not None:
        raise Refused(f"not a plain http(s) url: {url[:200]}")
    if port not in (None, 80, 443):
        raise Refused(f"port {port}")
    try:
        found = [str(ipaddress.ip_address(parts.hostname))]
    except ValueError:
        found = resolver(parts.hostname)
    if not found or not all(map(_public, found)):
        raise Refused(f"{parts.hostname} isn't public")
    return found[0]


class _Pinned(http.client.HTTPSConnection):
    """Connects to a checked address and keeps the host's name for the certificate."""

    def __init__(self, host: str, address: str, port: int) -> None:
        super().__init__(host, port, timeout=CONNECT_SECONDS, context=ssl.create_default_context())
        self.address = address

    def connect(self) -> None:
        raw = socket.create_connection((self.address, self.port), CONNECT_SECONDS)
        raw.settimeout(READ_SECONDS)
        self.sock = self._context.wrap_socket(raw, server_hostname=self.host)


def standard_client(url: str, address: str) -> Hop:
    parts = urlsplit(url)
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    if parts.scheme == "https":
        link: http.client.HTTPConnection = _Pinned(parts.hostname, address, parts.port or 443)
    else:
        link = http.client.HTTPConnection(address, parts.port or 80, timeout=READ_SECONDS)
    try:
        link.request("GET", path, headers={"Host": parts.netloc, "User-Agent": "feed-reader", "Accept-Encoding": "identity"})
        answer = link.getresponse()
    except (OSError, http.client.HTTPException) as e:
        link.close()
        raise FetchError(str(e)[:200]) from e

    def body() -> Iterator[bytes]:
        try:
            while piece := answer.read(1 << 16):
                yield piece
        finally:
            link.close()

    return Hop(answer.status, answer.getheader("Location"), body())


def fetch(url: str, client: Client = standard_client, resolver: Resolver = resolve) -> tuple[str, int, bytes]:
    """(final url, status, body): at most REDIRECTS hops on, each checked; bodies beyond BODY_BYTES are an error."""
    for _ in range(REDIRECTS + 1):
        hop = client(url, checked_address(url, resolver))
        if hop.status in (301, 302, 303, 307, 308) and hop.location:
            url = urljoin(url, hop.location)
            continue
        if hop.status >= 400:
            raise FetchError(f"status {hop.status}")
        held = bytearray()
        for piece in hop.body:
            held += piece
            if len(held) > BODY_BYTES:
                raise FetchError(f"more than {BODY_BYTES} bytes")
        return url, hop.status, bytes(held)
    raise FetchError(f"more than {REDIRECTS} redirects")


def fetch_source(source_id: str, url: str, client: Client = standard_client, resolver: Resolver = resolve, wait: Callable[[float], None] = time.sleep) -> tuple:
    """A row of FETCHED; never raises.  A failure is tried once more, a refusal isn't."""
    began = time.monotonic()
    error = None
    for turn in range(RETRIES + 1):
        try:
            return (source_id, *fetch(url, client, resolver), None, time.monotonic() - began)
        except Refused as e:
            error = str(e)[:200]
            break
        except Exception as e:  # whatever a server makes of it is this source's row
            error = str(e)[:200] or type(e).__name__
            if turn < RETRIES:
                wait(RETRY_WAIT)
    return source_id, url, None, None, error, time.monotonic() - began


def fetch_feeds(registry: DataFrame, client: Client = standard_client, resolver: Resolver = resolve, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """FETCHED rows of the registry's enabled sources (id, feed_url, enabled), a task each.

    ``content`` goes to :func:`feeds.parse_feeds`.  Evaluating it again fetches again: write it before use.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [fetch_source(s, u, client, resolver, wait) for s, u in zip(batch["id"], batch["feed_url"], strict=True)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in FETCHED.split(", ")]).astype({"status": "Int32"})

    live = registry.where("enabled").select("id", "feed_url")
    return live.repartition(max(1, live.count()), "id").mapInPandas(run, FETCHED)
