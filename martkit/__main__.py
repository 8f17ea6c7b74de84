"""``python -m martkit <command> ...``: the same command line as ``plans/cli.py``."""

import json

from martkit.plans.cli import main

print(json.dumps(main()))
