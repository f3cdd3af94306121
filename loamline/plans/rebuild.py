"""python -m loamline.plans.rebuild --raw-dir ... --out ...: a manifest from ingested repositories."""

from loamline.plans.pipeline import rebuild

if __name__ == "__main__":
    print(f"{rebuild()} entries")
