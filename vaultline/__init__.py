"""vaultline: incremental Data Vault loads and community analytics on Spark."""

__version__ = "0.1.0"
