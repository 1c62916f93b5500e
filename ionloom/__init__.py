"""Spectral analytics on Spark: tandem mass spectrometry tables as DataFrame plans."""
