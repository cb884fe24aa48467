"""Plain one-message-at-a-time model of the intake rules, for small fixtures only.

Paths in the fixtures are simple (no queries, no dispositions), so that the model can
state the path rules in a line each.
"""

import hashlib

REMOTE = ("http", "https", "ftp", "ftps", "sftp")
AS_OF_SECONDS = 1_700_000_000


def remote_path(uri):
    scheme, rest = uri.split("://")
    return f"remote/{scheme}/{rest}"


def lookup_target(raw):
    if raw.startswith("ingress/remote"):
        return "remote" + raw[len("ingress/remote"):]
    return "local" + raw[len("ingress"):] if raw.startswith("ingress") else raw


def local_target(source):
    if source.startswith("local/"):
        return source
    bare = source[len("ingress/"):] if source.startswith("ingress/") else source
    while bare.startswith("derivatives/derivatives/"):
        bare = bare[len("derivatives/"):]
    return "local/" + bare.replace("://", ":/")


def first_remote(origins):
    return next((o for o in origins if o["scheme"] in REMOTE), None)


def distinct(items):
    out = []
    for i in items:
        if i not in out:
            out.append(i)
    return out


class Model:
    def __init__(self, catalog, files, chains, bodies, mappings, tolerance):
        self.catalog = {r["doc_id"]: dict(r) for r in catalog}
        self.snapshot = dict(files)
        self.files = dict(files)
        self.chains, self.bodies = chains, bodies
        self.mappings = [dict(m) for m in mappings]
        self.tolerance = tolerance
        self.consumed = set()
        self.outcomes, self.actions = {}, []

    def run(self, m):
        raw = m["source"]
        remote = "://" in raw
        if remote:
            chain = self.chains.get(raw)
            if chain is None:
                return self.end(m, "no_document")
            uri = chain[0]["uri"]
            hash_, length = self.bodies[uri]
            sources, match_source, uris = {uri}, uri, {uri}
            temp = remote_path(uri).replace("remote/", "remote-ingress/", 1)
        else:
            if raw not in self.snapshot or raw in self.consumed:
                return self.end(m, "file_not_found")
            chain = None
            hash_, length = self.snapshot[raw]
            sources, match_source, uris, temp = {raw, lookup_target(raw)}, raw, set(), raw

        matches = sorted(
            (
                r for r in self.catalog.values()
                if r["hash"] == hash_ or r["source"] in sources
                or any(o["uri"] in uris for o in r["origin"] or [])
            ),
            key=lambda r: (r["created"], r["doc_id"]),
            reverse=True,
        )
        if matches and matches[0]["hash"] == hash_:
            doc, old = matches[0], matches[1:]
        else:
            doc_id = f"{AS_OF_SECONDS:08x}{m['seq']:016x}"
            doc, old = dict(
                doc_id=doc_id, source=match_source, hash=hash_, created=AS_OF_SECONDS, origin=None,
                tags=[], derivative=bool(m["derivative"]) and not remote, rogue=None, started=None,
            ), matches
            self.catalog[doc_id] = doc

        if self.tolerance is not None and doc["started"] is not None and (
            abs(AS_OF_SECONDS - doc["started"]) < self.tolerance
        ):
            return self.end(m, "run_too_recently", doc)
        if m["verify"] and abs(AS_OF_SECONDS - doc["created"]) > 10:
            return self.end(m, "silent_validation", doc)
        if doc["rogue"]:
            return self.end(m, "rogue_file", doc)
        for o in m["origins"]:
            if o["scheme"] in REMOTE and o["uri"] is None:
                return self.end(m, "missing_origin_uri", doc)
            if o["scheme"] in REMOTE and "://" not in o["uri"]:
                return self.end(m, "invalid_origin_scheme", doc)
        doc["started"] = AS_OF_SECONDS
        if length == 0:
            del self.catalog[doc["doc_id"]]
            return self.end(m, "zero_length", doc)

        current = distinct((doc["origin"] or []) + m["origins"])
        first = first_remote(current)
        if chain is not None or first is not None:
            placed = doc["source"].startswith("remote/")
            target = doc["source"] if placed else remote_path(
                chain[0]["uri"] if chain is not None else first["uri"]
            )
        else:
            placed = doc["source"].startswith("local/")
            target = doc["source"] if placed else local_target(doc["source"])
        occupant = self.files.get(target, (hash_, 0))[0]
        was = doc["source"]
        if occupant != hash_ or not placed:
            if occupant != hash_:
                for r in old:
                    del self.catalog[r["doc_id"]]
                    self.mappings = [e for e in self.mappings if e["parent"] != r["doc_id"]]
            if not remote and temp != target:
                self.consumed.add(raw)
                self.files.pop(raw, None)
            if temp != target:
                self.files[target] = (hash_, length)
                self.actions.append((m["seq"], "move", temp, target))
            if was.startswith("local/") and was not in (target, temp):
                self.actions.append((m["seq"], "orphan", was, None))
            doc["source"] = target
        elif temp != doc["source"]:
            self.actions.append((m["seq"], "remove", temp, None))
            if not remote:
                self.consumed.add(raw)
                self.files.pop(raw, None)
        doc["origin"] = chain if chain is not None else current
        doc["tags"] = distinct(m["tags"] + doc["tags"])
        doc["derivative"] = bool(m["derivative"])
        if doc["derivative"]:
            path = local_target(raw)
            for e in self.mappings:
                if e["child_path"] == raw:
                    e["child_path"], e["child"] = path, doc["doc_id"]
        return self.end(m, "ok", doc)

    def end(self, m, outcome, doc=None):
        self.outcomes[m["seq"]] = (outcome, doc and doc["doc_id"])


def digest(text):
    return hashlib.md5(text.encode()).hexdigest()
