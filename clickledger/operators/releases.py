"""Releases: registered, validated against a report, activated with an audited reason.

The registry is a journal: one numbered object per move, created once and never changed. What a release is now follows from its moves. Two writers
that decide at the same time want the same number; one of them gets it, and the other looks again.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field

from clickledger.functions.contracts import Rules
from clickledger.operators.paging import valid_release
from clickledger.sources.files import LocalFiles

#: What may be done to a release: the states it may be in, and the state it is in afterwards.
MOVES = {
    "register": ({None}, "building"),
    "fail": ({"building"}, "failed"),
    "validate": ({"building"}, "validated"),
    "activate": ({"validated", "retired"}, "active"),
    "retire": ({"active"}, "retired"),
}
#: Parts of a report that a list of releases leaves out.
BULKY = ("differences", "processing_pending")
#: What a report must confirm before its release counts as valid.
PROOFS = ("passed", "archive_complete", "sink_complete")


@dataclass
class State:
    """The journal read to its end."""

    moves: int = 0
    active: str | None = None
    releases: dict[str, dict] = field(default_factory=dict)
    audit: list[dict] = field(default_factory=list)

    def apply(self, entry: dict) -> None:
        self.moves += 1
        move, name = entry["move"], entry["release_id"]
        release = self.releases.setdefault(name, {})
        release |= entry.get("facts", {}) | {"release_id": name, "status": MOVES[move][1]}
        if move == "activate":
            if self.active is not None:
                self.releases[self.active]["status"] = MOVES["retire"][1]
            self.audit.append({"previous": self.active, "next": name, "reason": entry["reason"], "at": entry["at"]})
            self.active = name

    def status(self, release: str) -> str | None:
        return self.releases.get(release, {}).get("status")


class Registry:
    def __init__(self, path: str, files=None):
        self._path, self._files = str(path).rstrip("/"), files or LocalFiles()
        self._known = State()

    def _state(self) -> State:
        """The state now: only moves that came since the last look are read."""
        while (data := self._files.read(f"{self._path}/{self._known.moves + 1:08d}.json")) is not None:
            self._known.apply(json.loads(data))
        return self._known

    def _move(self, move: str, release: str, **more) -> None:
        while True:
            state = self._state()
            if state.status(release) not in MOVES[move][0]:
                raise ValueError(f"cannot {move} a release that is {state.status(release) or 'unknown'}")
            entry = {"move": move, "release_id": release, "at": time.time()} | more
            if self._files.create(f"{self._path}/{state.moves + 1:08d}.json", json.dumps(entry, sort_keys=True).encode()):
                self._state()
                return

    def register(self, release: str, rules: Rules, kind: str = "replay", manifest_sha256: str | None = None) -> None:
        """A release of its own rules. The live release may be registered again as long as its rules are the same."""
        if not valid_release(release):
            raise ValueError("not a release id")
        known = self.get(release)
        if known and kind == known["kind"] == "live" and known["rules_sha256"] == rules.digest():
            return
        facts = {"kind": kind, "rules": rules.document(), "rules_sha256": rules.digest(), "manifest_sha256": manifest_sha256, "created_at": time.time(), "report": None}
        self._move("register", release, facts=facts)

    def validate(self, release: str, report: dict) -> None:
        lacking = [p for p in PROOFS if not report.get(p)]
        if lacking:
            raise ValueError(f"the report does not confirm: {', '.join(lacking)}")
        self._move("validate", release, facts={"report": report, "validated_at": time.time()})

    def fail(self, release: str) -> None:
        self._move("fail", release)

    def activate(self, release: str, reason: str) -> dict:
        """Make a release the active one; what was active is retired and can come back. Nothing happens to the one that is active already."""
        if not reason.strip():
            raise ValueError("a reason is required")
        before = self.active()
        if before != release:
            self._move("activate", release, reason=reason)
        return {"previous": before, "active": release, "changed": before != release}

    def get(self, release: str) -> dict | None:
        return self._state().releases.get(release)

    def active(self) -> str | None:
        return self._state().active

    def audit(self) -> list[dict]:
        return self._state().audit

    def list(self) -> list[dict]:
        """Newest first, without the bulky parts."""
        out = []
        for r in sorted(self._state().releases.values(), key=lambda r: -r["created_at"]):
            short = {k: v for k, v in r.items() if k not in ("rules", "report")}
            out.append(short | {"rule_version": r["rules"]["rule_version"], "report": {k: v for k, v in (r["report"] or {}).items() if k not in BULKY}})
        return out
