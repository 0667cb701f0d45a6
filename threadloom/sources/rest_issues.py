"""A Python data source for a REST issue tracker: one input partition for each page, retries inside the reader.

`spark.dataSource.register(IssueSource)`, then `spark.read.format("rest_issues").option("repo", "owner/name").load()`.
Rows are the raw API objects as JSON text; `operators.flatten.normalize_issues` makes the typed table of them. The state
filter and the sort order are request parameters, so the server applies them. Page size is fixed, so pages never shift.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

API = "https://api.github.com"
SCHEMA = "issue string, comments string, reviews string"


def fetch(url: str, params: dict, token: str = "", opener=urllib.request.urlopen, sleep=time.sleep, attempts: int = 3):
    """GET with retries: a limit that is exceeded waits until its reset, other errors are raised."""
    if params:
        url = f"{url}?{urllib.parse.urlencode(params)}"
    request = urllib.request.Request(url, headers={"Authorization": f"Bearer {token}"} if token else {})
    for attempt in range(attempts):
        try:
            with opener(request, timeout=30) as reply:
                return json.loads(reply.read())
        except urllib.error.HTTPError as e:
            if e.code not in (403, 429) or attempt == attempts - 1:
                raise
            reset = float((e.headers or {}).get("X-RateLimit-Reset", 0))
            sleep(max(1.0, reset - time.time()))
    raise RuntimeError("no attempts")


def fetch_pages(url: str, get, size: int = 100) -> list:
    """All pages of a list, up to the first that is not full."""
    out, page = [], 1
    while True:
        rows = get(url, {"per_page": size, "page": page})
        out.extend(rows)
        if len(rows) < size:
            return out
        page += 1


class IssueReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        limit, size = int(self.options.get("limit", 100)), int(self.options.get("page_size", 100))
        return [InputPartition((page, min(size, limit - (page - 1) * size))) for page in range(1, -(-limit // size) + 1)]

    def read(self, partition):
        page, take = partition.value
        o = self.options
        base = f"{o.get('api', API)}/repos/{o['repo']}"

        def get(url, params):
            return fetch(url, params, o.get("token", ""))

        params = {"state": o.get("state", "closed"), "sort": "updated", "direction": "desc", "per_page": int(o.get("page_size", 100)), "page": page}
        for issue in get(f"{base}/issues", params)[:take]:
            comments = fetch_pages(issue["comments_url"], get) if issue.get("comments") else []
            reviews = []
            if "pull_request" in issue:
                try:
                    reviews = get(f"{base}/pulls/{issue['number']}/reviews", {"per_page": 100})
                except Exception:  # noqa: BLE001  reviews are optional: any error means none
                    reviews = []
            yield json.dumps(issue), json.dumps(comments), json.dumps(reviews)


class IssueSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rest_issues"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> IssueReader:
        return IssueReader(dict(self.options))
