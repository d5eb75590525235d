"""playmart: a song-play star schema built with PySpark DataFrames."""
