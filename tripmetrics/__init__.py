"""Trip-record preparation and analysis as plain DataFrame functions."""
