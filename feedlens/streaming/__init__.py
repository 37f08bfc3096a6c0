from feedlens.streaming.incremental_cube import start_incremental_cube

__all__ = ["start_incremental_cube"]
