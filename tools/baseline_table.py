
import json
import sys

data = json.loads(open(sys.argv[1]).read().strip().splitlines()[-1])
cfg = f"local[{data['cpus']}], {data['shuffle_partitions']} shuffle partitions, Spark {data['spark']}"
print("| Query | sec (median of %d) | Rows | Config (cores, shuffle partitions, Spark version) |" % data["runs"])
print("| --- | --- | --- | --- |")
for name, sec in data["queries"].items():
    rows = data.get("rows", {}).get(name, "")
    print(f"| `{name}` | {sec:.3f} | {rows:,} | {cfg} |" if rows != "" else f"| `{name}` | {sec:.3f} | | {cfg} |")
print(f"| **sum** | **{data['value']:.1f}** | | sf {data['sf']} |")
