"""Clients of the bulk sink that fail on purpose; imported by the workers."""

import os

from eventflow.sinks.bulk import FolderClient


class Flaky(FolderClient):
    """Rejects the first ``fails`` bulks that hold the document ``poison`` (or any)."""

    def __init__(self, options):
        super().__init__(options)
        self.log, self.fails, self.poison = options["log"], int(options["fails"]), options.get("poison")

    def stage(self, write, bulk, docs):
        if self.poison is None or self.poison in docs:
            with open(self.log, "a") as f:
                f.write(f"{bulk}\n")
            with open(self.log) as f:
                if len(f.readlines()) <= self.fails:
                    raise IOError("bulk rejected")
        super().stage(write, bulk, docs)


class FailingCommit(FolderClient):
    """Dies once in the middle of a publication, after the first bulk has moved."""

    def __init__(self, options):
        super().__init__(options)
        self.log = options["log"]

    def publish(self, write, target, bulks, documents):
        if not os.path.exists(self.log):
            open(self.log, "w").close()
            os.makedirs(f"{self.root}/{target}", exist_ok=True)
            self.fs.move(f"{self.root}/_staging/{write}/{bulks[0]}", f"{self.root}/{target}/{bulks[0]}")
            raise IOError("driver died")
        super().publish(write, target, bulks, documents)
