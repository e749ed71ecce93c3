"""Where relations come from: Parquet sources, the driver tables, platform exports, small inputs."""
