"""Text sources: delimited record lines, gold mapping lines, stopword lists."""
