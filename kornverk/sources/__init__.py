"""Sources and sinks: JSON lines in one file or in parts, archives, audio files and reports."""
