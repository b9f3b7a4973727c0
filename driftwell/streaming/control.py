"""The verbs by which a replication is controlled, as a command line or an endpoint would pass them on."""

from __future__ import annotations

import json

from .replicator import Replicator

#: Names of the verbs, fixed values, and what they ask for.
VERBS = {
    "start_replica": (), "stop_replica": (), "restart": (), "show_replica_status": (), "change_replication_source": ("binlog_file", "binlog_position", "gtid"),
    "lsn": ("lsn",), "delete_offsets": (), "delete_schema_history": (),
}


def command(replicator: Replicator, verb: str, **given: str) -> tuple[int, str]:
    """(status, JSON text) as an endpoint would answer: 200 done, 400 not now or not so, 404 no such verb."""
    if verb not in VERBS:
        return 404, json.dumps({"error": f"no verb {verb}"})
    if wrong := set(given) - set(VERBS[verb]):
        return 400, json.dumps({"error": f"not asked for: {', '.join(sorted(wrong))}"})
    try:
        if verb == "start_replica":
            replicator.start()
        elif verb == "stop_replica":
            replicator.stop()
        elif verb == "restart":
            replicator.restart()
        elif verb == "change_replication_source":
            replicator.set_position(file=given.get("binlog_file"), pos=given.get("binlog_position"), gtids=given.get("gtid"))
        elif verb == "lsn":
            replicator.set_position(lsn=given["lsn"])
        elif verb == "delete_offsets":
            replicator.reset_offsets()
        elif verb == "delete_schema_history":
            if replicator.running:
                raise RuntimeError("stop the replication first")
            if replicator.applier.history is not None:
                replicator.applier.history.delete()
    except (RuntimeError, KeyError, ValueError) as e:
        return 400, json.dumps({"error": str(e)})
    return 200, json.dumps(replicator.status(), default=str)


def main(replicator: Replicator, words: list[str]) -> int:
    """A command line: the verb, then name=value for what it asks for. Prints the answer; 0 if it was done."""
    status, text = command(replicator, words[0] if words else "", **dict(w.split("=", 1) for w in words[1:] if "=" in w))
    print(text)
    return 0 if status == 200 else 1
