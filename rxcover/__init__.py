"""rxcover: medicines dictionary mapping and coverage analytics on Spark.

Products and their classification records are read as DataFrames, joined
into one typed table (the spine), and summarised into coverage reports and
a dose lookup. Everything is DataFrame operations; see ``README.md``.

Main entry points: :func:`rxcover.build.run_build`,
:func:`rxcover.build.run_reports`, the operators in :mod:`rxcover.operators`
and the readers in :mod:`rxcover.sources.xml`.
"""

__version__ = "0.1.0"

__all__ = ["run_build", "run_reports", "__version__"]


def __getattr__(name):
    # Imported on first use so that importing the package stays cheap.
    if name in ("run_build", "run_reports"):
        from rxcover import build

        return getattr(build, name)
    raise AttributeError(name)
