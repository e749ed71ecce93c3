"""Revenue-driver analytics for multi-branch food service, written as Spark DataFrame plans."""
