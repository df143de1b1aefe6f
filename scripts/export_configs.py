"""Write the retail model's job and gold configs as JSON files.

Usage: python scripts/export_configs.py RAW_ROOT LAKE_ROOT OUT_DIR
then:  python -m strata.plans.pipeline --layer all --jobs-dir OUT_DIR/jobs \\
           --gold-dir OUT_DIR/gold --ledger LAKE_ROOT/control/ledger
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.pipeline import LakeLayout, retail_gold, retail_jobs  # noqa: E402


def main(raw: str, lake: str, out: str) -> None:
    layout = LakeLayout(raw.rstrip("/"), lake.rstrip("/"))
    for sub, configs in (("jobs", retail_jobs(layout)), ("gold", retail_gold(layout))):
        os.makedirs(os.path.join(out, sub), exist_ok=True)
        for i, cfg in enumerate(configs):
            name = f"job_{i + 1:02d}_{cfg['dataset']}.json" if sub == "jobs" else f"{cfg['dataset']}.json"
            with open(os.path.join(out, sub, name), "w") as fh:
                json.dump(cfg, fh, indent=2)
                fh.write("\n")


if __name__ == "__main__":
    if len(sys.argv) != 4:
        sys.exit(__doc__)
    main(*sys.argv[1:])
