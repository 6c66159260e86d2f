from basketry.sources import files, testdata

__all__ = ["files", "testdata"]
