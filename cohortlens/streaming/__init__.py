from cohortlens.streaming.score_stream import score_stream

__all__ = ["score_stream"]
