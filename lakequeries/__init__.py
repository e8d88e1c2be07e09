"""The library's operators applied to the driver's tables, with equivalent SQL for comparison."""
