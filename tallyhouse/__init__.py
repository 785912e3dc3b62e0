"""Three-layer retail sales warehouse (staging -> core -> mart) as PySpark DataFrame plans."""
