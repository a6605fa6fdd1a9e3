"""``python -m layerwise job.json``: run the land → clean → aggregate job (see plans.layered)."""

from layerwise.plans.layered import main

if __name__ == "__main__":
    main()
