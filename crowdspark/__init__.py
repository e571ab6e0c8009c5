"""PySpark operators for motion-triggered image surveys and crowd-sourced labels."""
