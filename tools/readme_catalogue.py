"""Write the plan catalogue of README.md anew from the registered plans."""

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main():
    from tillroll.plans import catalog
    plans = catalog.load_all()
    by = {}
    for p in plans.values():
        by.setdefault(p.build.__module__.rpartition(".")[2], []).append(p)
    lines = ["## Plan catalogue", ""]
    for module in catalog._MODULES:
        lines += [f"**{module}**", "", "| plan | operators (SURVEY §2 ids) | oracle |", "| --- | --- | --- |"]
        lines += [f"| `{p.name}` | {p.ops} | {'DuckDB SQL' if p.sql else 'rows only'} |" for p in by.get(module, [])]
        lines.append("")
    path = os.path.join(ROOT, "README.md")
    with open(path) as f:
        text = f.read()
    with open(path, "w") as f:
        f.write(re.sub(r"## Plan catalogue\n.*", "\n".join(lines), text, flags=re.S))
    print(len(plans), "plans,", sum(bool(p.sql) for p in plans.values()), "with an oracle")


if __name__ == "__main__":
    main()
